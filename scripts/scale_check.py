"""Scaling check: time operators on k-fold copies of ``events`` (ids shifted, so the activity values change).

Writes each copy once to a fresh scratch folder (several files, so scans split), then runs the operators on the
activity view derived from it. Not a registered query; a tool for seeing how time grows with the rows.

    python scripts/scale_check.py [sf_dir] [factor ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pulsekit.operators import clean as cl  # noqa: E402
from pulsekit.operators import distribution as di  # noqa: E402
from pulsekit.operators import evaluate as ev  # noqa: E402
from pulsekit.operators import profile as pr  # noqa: E402
from pulsekit.operators import sample as sa  # noqa: E402
from pulsekit.functions import expressions as ex  # noqa: E402
from pulsekit.session import ensure_checkpoint_dir, get_spark  # noqa: E402
from pulsekit.sources.fixtures import ACTIVITY_SELECT, LABEL_COL, NUMERIC_COLS  # noqa: E402

CLASSES = ["Cardio", "Strength", "Yoga", "None"]
OPS = {
    "numeric_monitoring_exact": lambda a: pr.numeric_monitoring(a, NUMERIC_COLS),
    "numeric_monitoring_approx": lambda a: pr.numeric_monitoring(a, NUMERIC_COLS, median="approx"),
    "ks_two_sample": lambda a: di.ks_two_sample(a, NUMERIC_COLS, LABEL_COL, CLASSES),
    "ks_normality": lambda a: di.ks_normality(a, NUMERIC_COLS),
    "jensen_shannon": lambda a: di.jensen_shannon(a, NUMERIC_COLS, LABEL_COL, CLASSES),
    "kde_binned_4096": lambda a: di.kde_curves(a, NUMERIC_COLS, LABEL_COL, bins=4096),
    "undersample": lambda a: sa.undersample(cl.clean(a, cl.STRICT_RULES), LABEL_COL),
    "rule_metrics": lambda a: ev.classification_metrics(a.withColumn("p", ex.rule_class()), LABEL_COL, "p"),
    "auc": lambda a: ev.auc_roc(a.select((F.col(LABEL_COL) == "Cardio").cast("double").alias("label"),
                                         F.col("Heart_Rate_avg").alias("score")), "label", "score", 1.0),
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    factors = [int(x) for x in sys.argv[2:]] or [1, 10, 30]
    spark = get_spark("local[8]", app_name="pulsekit-scale", shuffle_partitions=32,
                      conf={"spark.driver.memory": "16g"})
    ensure_checkpoint_dir(spark)
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="pulsekit-scale-")
    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    span = events.agg(F.max("event_id")).first()[0] + 1
    results = {}
    for k in factors:
        path = os.path.join(scratch, f"events_x{k}.parquet")
        copies = events.withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))) \
            .withColumn("event_id", F.col("event_id") + F.col("_rep") * F.lit(span)).drop("_rep")
        copies.repartition(16).write.parquet(path)
        act = spark.sql(ACTIVITY_SELECT, events=spark.read.parquet(path))
        rows = act.count()
        times = {}
        for name, op in OPS.items():
            t0 = time.perf_counter()
            op(act).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 2)
        results[f"x{k}"] = {"rows": rows, "seconds": times}
        print(json.dumps({f"x{k}": results[f"x{k}"]}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
