"""Connected components of an edge table by randomised contraction, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import materialize, release


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> one row (node, component) per node of an edge; component is the smallest node of it.

    In each round every node is contracted into the closed neighbour with the smallest hash of that round. The hash
    changes per round, so the nodes left shrink by a constant factor in expectation whatever the graph's shape, and
    no node's neighbour list is ever gathered: a round is one ``min_by`` aggregation and two joins. Each round's
    tables are written to the shared folder and removed once the result no longer needs them. Null ends and loops are
    ignored.
    """
    live = edges.select("a", "b").where("a <> b")
    steps: list[DataFrame] = []
    used: list[DataFrame] = []
    while True:
        live = materialize(live.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        release(*used)
        used = [live]
        if live.isEmpty():
            break
        salt = F.lit(len(steps))
        both = live.select(F.explode(F.array(
            F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
            F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")).select("e.*")
        near = both.groupBy("node").agg(F.min_by("other", F.struct(F.xxhash64("other", salt), "other")).alias("other"))
        own, others = F.struct(F.xxhash64("node", salt), "node"), F.struct(F.xxhash64("other", salt), "other")
        step = materialize(near.select("node", F.when(own < others, F.col("node")).otherwise(F.col("other")).alias("into")))
        steps.append(step)
        live = (live.join(step.withColumnsRenamed({"node": "a", "into": "x"}), "a")
                .join(step.withColumnsRenamed({"node": "b", "into": "y"}), "b")
                .select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b"))
    release(*used)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    roots = steps[0].select("node", F.col("into").alias("root"))
    for step in steps[1:]:
        roots = (roots.join(step.withColumnsRenamed({"node": "root"}), "root", "left")
                 .select("node", F.coalesce("into", "root").alias("root")))
    roots = materialize(roots)
    release(*steps)
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(least, "root").select("node", "component")
