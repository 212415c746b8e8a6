"""Execute registered queries and summarise their final physical plans.

Per query: parquet scans, shuffles (hash / range / single-partition), broadcast and sort-merge joins, nested-loop or
cartesian joins (there should be none), windows and subqueries. Usage: python scripts/plan_audit.py [sf_dir] [name..]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsekit.plans import catalog  # noqa: E402
from pulsekit.session import get_spark  # noqa: E402

PATTERNS = {
    "scans": r"FileScan parquet|Scan parquet",
    "hash_shuffle": r"Exchange hashpartitioning",
    "range_shuffle": r"Exchange rangepartitioning",
    "single_part": r"Exchange SinglePartition",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow \[",
    "subquery": r"Subquery subquery",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print("query," + ",".join(PATTERNS))
    for name, fn in catalog.QUERIES.items():
        if (only and name not in only) or (not only and name not in catalog.ORACLES):
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(p, plan)) for p in PATTERNS.values()]
        print(name + "," + ",".join(str(c) for c in counts))
    spark.stop()


if __name__ == "__main__":
    main()
