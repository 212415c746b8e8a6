"""Train/test split and class rebalancing.

Every random choice is ``hash01(key, seed)``: a pure function of the row key, so results do not depend on the
partitioning, on task retries after executor loss, or on the engine (the DuckDB oracle computes the same numbers).
Class counts are one grouped aggregate (one row per class), joined back by label as a broadcast table whose size
is checked, never a loop of filtered scans; a class holding a third of all rows is never shuffled into one task.
A NULL key counts as the empty string, so such rows are on one side of a split together and are never lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash01
from .ordered import with_scalars


def split_column(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 42,
                 out_col: str = "split", hash_method: str = "md5") -> DataFrame:
    """F1 as a column: ``'train'`` where ``hash01(key, seed) < train_fraction`` else ``'test'``."""
    h = hash01(key, seed, hash_method)
    return df.withColumn(out_col, F.when(h < F.lit(float(train_fraction)), F.lit("train"))
                         .otherwise(F.lit("test")))


def train_test_split(df: DataFrame, key: str | None = "row_id", train_fraction: float = 0.8,
                     seed: int = 42, hash_method: str = "md5") -> tuple[DataFrame, DataFrame]:
    """``(train, test)``. With ``key=None`` falls back to ``randomSplit`` (depends on partitioning)."""
    if key is None:
        train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
        return train, test
    h = hash01(key, seed, hash_method)
    return df.where(h < F.lit(float(train_fraction))), df.where(h >= F.lit(float(train_fraction)))


MAX_BROADCAST_ROWS = 100_000


def _class_table(df: DataFrame, label_col: str, ratio) -> DataFrame:
    """One row per non-NULL class with ``_value`` = ``ratio(count, min_count, max_count)``.

    The counts stay a table; the driver reads no more than whether there are ``MAX_BROADCAST_ROWS`` classes or fewer.
    If so the table is broadcast to the rows, so a class holding most rows is never shuffled into one task; beyond,
    it joins like any other table and AQE splits skewed partitions. The rows are the same either way. Rows with a
    NULL label never take part in balancing.
    """
    counts = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    bounds = counts.agg(F.min("_n").alias("_lo"), F.max("_n").alias("_hi"))
    n, lo, hi = (F.col(c).cast("double") for c in ("_n", "_lo", "_hi"))
    table = with_scalars(counts, bounds).select(label_col, ratio(n, lo, hi).alias("_value"))
    few = counts.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    return F.broadcast(table) if few else table


def undersample(df: DataFrame, label_col: str, key: str = "row_id", seed: int = 42,
                hash_method: str = "md5") -> DataFrame:
    """Bernoulli-sample every class at ``min_count / class_count`` (the minority class is kept whole).

    Expected class sizes are all the minority count, as with the reference's per-class ``sample``; one pass over the
    data and a join with the class-count table, no per-class scan and no union. The random number is one of its own,
    independent of the split's, so the rates also hold after a split on the same key and seed.
    """
    joined = df.join(_class_table(df, label_col, lambda n, lo, hi: lo / n), label_col, "inner")
    return joined.where(hash01(key, seed, hash_method, "balance") < F.col("_value")).drop("_value")


def oversample(df: DataFrame, label_col: str, key: str = "row_id", seed: int = 42,
               copy_col: str = "copy_id", chunk: int = 256, hash_method: str = "md5") -> DataFrame:
    """duplicate every class toward the majority count.

    A row of a class with ``count`` rows appears ``floor(max/count)`` times, plus once more when the row's random
    number (see ``undersample``) is below ``frac(max/count)``, so the expected class size is exactly the majority
    count (the reference's self-union doubles instead). ``copy_col`` numbers the copies from 1.

    When some row needs more than ``chunk`` copies (a tiny class next to a huge one), its copies are first cut into
    chunks of ``chunk`` and the chunks are hash-spread over the shuffle partitions before the final explode, so a
    handful of minority rows does not generate the whole class inside a handful of tasks. The rows are the same.
    """
    ratios = _class_table(df, label_col, lambda n, lo, hi: hi / n)
    joined = df.join(ratios, label_col, "inner").withColumnRenamed("_value", "_ratio")
    whole = F.floor(F.col("_ratio"))
    extra = hash01(key, seed, hash_method, "balance") < F.col("_ratio") - whole
    copies = (whole + F.when(extra, 1).otherwise(0)).cast("long")
    if (ratios.agg(F.max("_value")).first()[0] or 0.0) <= chunk:
        return joined.withColumn(copy_col, F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop("_ratio")
    step = F.lit(chunk).cast("long")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    chunked = joined.withColumn("_n_copies", copies) \
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n_copies") - 1) / step)
                                                   .cast("long")))) \
        .repartition(parts, key, "_chunk")
    first = F.col("_chunk") * step + 1
    last = F.least(F.col("_n_copies"), (F.col("_chunk") + 1) * step)
    return chunked.withColumn(copy_col, F.explode(F.sequence(first, last))) \
        .drop("_ratio", "_n_copies", "_chunk")


def balance(df: DataFrame, label_col: str, strategy: str = "undersample", key: str = "row_id",
            seed: int = 42, hash_method: str = "md5") -> DataFrame:
    """dispatch; ``"none"`` passes the input through, anything unknown raises."""
    if strategy == "undersample":
        return undersample(df, label_col, key, seed, hash_method)
    if strategy == "oversample":
        return oversample(df, label_col, key, seed, hash_method=hash_method)
    if strategy == "none":
        return df
    raise ValueError(f"unknown balancing strategy {strategy!r}")
