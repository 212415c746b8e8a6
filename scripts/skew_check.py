"""Skew check from Spark's event log: does any task get the hot value?

Builds the activity table from a k-fold copy of ``events`` and makes one Heart_Rate_avg value and one class hold a
third of all rows. Runs operators with the event log written to a fresh scratch folder, then reads the task-end
events: for every stage with several tasks, the largest share of the stage's records (shuffle or input) that a
single task handled. Without skew handling that share would reach the hot third. Not a registered query.

    python scripts/skew_check.py [sf_dir] [factor] [--no-coalesce]

``--no-coalesce`` turns off AQE partition coalescing, which merges small shuffle partitions into a few tasks and
so hides how evenly the keys themselves spread; with it off, the shares show the distribution by key.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pulsekit.operators import clean as cl  # noqa: E402
from pulsekit.operators import distribution as di  # noqa: E402
from pulsekit.operators import profile as pr  # noqa: E402
from pulsekit.operators import sample as sa  # noqa: E402
from pulsekit.session import ensure_checkpoint_dir, get_spark  # noqa: E402
from pulsekit.sources.fixtures import ACTIVITY_SELECT, LABEL_COL, NUMERIC_COLS  # noqa: E402

CLASSES = ["Cardio", "Strength", "Yoga", "None"]
OPS = {
    "numeric_monitoring": lambda a: pr.numeric_monitoring(a, NUMERIC_COLS),
    "ks_two_sample": lambda a: di.ks_two_sample(a, NUMERIC_COLS, LABEL_COL, CLASSES),
    "ks_normality": lambda a: di.ks_normality(a, NUMERIC_COLS),
    "jensen_shannon": lambda a: di.jensen_shannon(a, NUMERIC_COLS, LABEL_COL, CLASSES),
    "kde_curves": lambda a: di.kde_curves(a, NUMERIC_COLS, LABEL_COL),
    "per_class_describe": lambda a: pr.per_class_describe(a, NUMERIC_COLS, LABEL_COL),
    "undersample": lambda a: sa.undersample(cl.clean(a, cl.STRICT_RULES), LABEL_COL),
}


def stage_shares(log_path: str) -> dict[str, float]:
    """Per job description: the largest share of a multi-task stage's records handled by one task."""
    stage_job, job_desc = {}, {}
    records = defaultdict(list)
    with open(log_path) as fh:
        for line in fh:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description")
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = desc
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0) \
                    or (m.get("Input Metrics") or {}).get("Records Read", 0)
                records[ev["Stage ID"]].append(n)
    worst: dict[str, float] = defaultdict(float)
    for sid, counts in records.items():
        total = sum(counts)
        desc = stage_job.get(sid)
        if desc and len(counts) > 1 and total >= 1000:
            worst[desc] = max(worst[desc], max(counts) / total)
    return dict(worst)


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    k = int(args[1]) if len(args) > 1 else 10
    coalesce = "--no-coalesce" not in sys.argv
    scratch = tempfile.mkdtemp(prefix="pulsekit-skew-")
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs)
    spark = get_spark("local[8]", app_name="pulsekit-skew", shuffle_partitions=32,
                      conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                            "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
                            "spark.sql.adaptive.coalescePartitions.enabled": str(coalesce).lower()})
    ensure_checkpoint_dir(spark)
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    span = events.agg(F.max("event_id")).first()[0] + 1
    path = os.path.join(scratch, "events.parquet")
    events.withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))) \
        .withColumn("event_id", F.col("event_id") + F.col("_rep") * F.lit(span)).drop("_rep") \
        .repartition(16).write.parquet(path)
    act = spark.sql(ACTIVITY_SELECT, events=spark.read.parquet(path))
    hot = F.col("row_id") % 3 == 0  # a third of all rows share one heart rate and one class
    act = act.withColumn("Heart_Rate_avg", F.when(hot, F.lit(120.0)).otherwise(F.col("Heart_Rate_avg"))) \
        .withColumn(LABEL_COL, F.when(hot, F.lit("None")).otherwise(F.col(LABEL_COL)))
    for name, op in OPS.items():
        spark.sparkContext.setJobDescription(name)
        op(act).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    log_file = max(glob.glob(os.path.join(logs, "*")), key=os.path.getmtime)
    shares = stage_shares(log_file)
    print(json.dumps({"rows": k * 100000, "hot_share": 1 / 3, "coalesce": coalesce,
                      "max_task_share": {n: round(shares.get(n, 0.0), 4) for n in OPS}}))


if __name__ == "__main__":
    main()
