"""Monitoring statistics and data profiling (C1-C16), each one distributed aggregation job.

Wide statistics are computed in a single ``agg`` (partial aggregation per task, one tiny final merge) and reshaped
into long form afterwards with ``inline`` on the one-row result, so the raw table is scanned once per report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import imbalance_flag, safe_div
from .gram import pair_moments
from .ordered import quantile_disc, with_scalars


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def numeric_monitoring(df: DataFrame, numeric_cols: Sequence[str], median: str = "exact",
                       accuracy: int = 10000, num_partitions: int | None = None, bracket: bool = True) -> DataFrame:
    """One row with ``<col>_Mean, _Median, _StdDev, _Variance, _Min, _Max`` per column.

    StdDev and Variance are the sample versions. ``median="exact"`` is the discrete median (SQL ``percentile_disc``)
    computed by a range-partitioned cumulative count, so no task ever sees a whole column; ``"approx"`` is
    ``percentile_approx`` at ``accuracy``, as in the reference. Medians are doubles.

    ``bracket`` (exact mode): rank only the values inside a ``percentile_approx`` bracket (an extra sketch pass;
    the right choice for continuous columns at scale) or, with ``False``, every distinct value (cheaper when the
    columns have few distinct values).
    """
    cols = list(numeric_cols)
    stats = []
    for c in cols:
        stats.append(F.avg(_d(c)).alias(f"{c}_Mean"))
        if median == "approx":
            stats.append(F.percentile_approx(_d(c), 0.5, accuracy).alias(f"{c}_Median"))
        stats += [F.stddev_samp(_d(c)).alias(f"{c}_StdDev"), F.var_samp(_d(c)).alias(f"{c}_Variance"),
                  F.min(c).alias(f"{c}_Min"), F.max(c).alias(f"{c}_Max")]
    row = df.agg(*stats)
    order = [f"{c}_{s}" for c in cols for s in ("Mean", "Median", "StdDev", "Variance", "Min", "Max")]
    if median == "approx":
        return row.select(*order)
    if median != "exact":
        raise ValueError(f"median must be 'exact' or 'approx', got {median!r}")
    long = df.select([_d(c).alias(c) for c in cols]).unpivot([], cols, "column", "value")
    medians = quantile_disc(long, ["column"], "value", 0.5, num_partitions, out_col="median",
                            bracket_accuracy=accuracy if bracket else None, max_groups=len(cols))
    wide = medians.agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"{c}_Median") for c in cols])
    return with_scalars(row, wide).select(*order)


def categorical_monitoring(df: DataFrame, col: str) -> DataFrame:
    """``Mode, Unique_Count, Missing_Rate`` in one grouped pass.

    Mode is the most frequent value, the NULL group included (as in the reference); ties go to the smallest value,
    NULL last, so the answer is repeatable. Unique_Count ignores NULL. Missing_Rate is NULL for an empty input.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct((-F.col("_n")).alias("a"), F.col(col).isNull().alias("b"), F.col(col).alias("c"))
    return counts.agg(
        F.min_by(F.col(col), rank).alias("Mode"),
        F.count(F.col(col)).cast("long").alias("Unique_Count"),
        safe_div(F.sum(F.when(F.col(col).isNull(), F.col("_n")).otherwise(0)), F.sum("_n")).alias("Missing_Rate"),
    )


def describe_numeric(df: DataFrame, numeric_cols: Sequence[str]) -> DataFrame:
    """Typed ``describe()``: ``column, count, mean, stddev, min, max`` (stddev is the sample one)."""
    cols = list(numeric_cols)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.avg(_d(c)).alias(f"m{i}"), F.stddev_samp(_d(c)).alias(f"s{i}"),
                 F.min(_d(c)).alias(f"lo{i}"), F.max(_d(c)).alias(f"hi{i}")]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("long").alias("count"),
                        F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*structs)))


def describe_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C8 for string columns: ``column, count, min, max`` in one pass (mean and stddev are undefined for text)."""
    cols = list(cols)
    row = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(c).alias(f"n{i}"), F.min(F.col(c).cast("string")).alias(f"lo{i}"), F.max(F.col(c).cast("string")).alias(f"hi{i}"))])
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("long").alias("count"), F.col(f"lo{i}").alias("min"),
                        F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*structs)))


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """``label, count, percentage`` sorted by count descending, then label (NULL group kept)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
    # The total is a scalar subquery over the per-class table: no window, no task that holds all classes.
    shared = with_scalars(counts, counts.agg(F.sum("count").alias("_total")))
    return shared.select(label_col, "count", (safe_div(F.col("count"), F.col("_total")) * 100).alias("percentage")) \
        .orderBy(F.desc("count"), F.asc_nulls_last(label_col))


def class_imbalance(df: DataFrame, label_col: str, threshold: float = 5.0) -> DataFrame:
    """C11: ``max_count, min_count, imbalance_ratio, severe``; a NULL class counts, as in the reference."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    out = counts.agg(F.max("_n").cast("long").alias("max_count"), F.min("_n").cast("long").alias("min_count"),
                     F.count(F.lit(1)).cast("long").alias("num_classes"))
    return out.withColumn("imbalance_ratio", safe_div("max_count", "min_count")) \
        .withColumn("severe", imbalance_flag("imbalance_ratio", threshold))


def per_class_describe(df: DataFrame, numeric_cols: Sequence[str], label_col: str) -> DataFrame:
    """``label, column, count, mean, stddev, min, max`` from one grouped pass (no filter loop).

    Rows whose label is NULL are left out: the reference's ``== None`` filter selects nothing for them.
    """
    cols = list(numeric_cols)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.avg(_d(c)).alias(f"m{i}"), F.stddev_samp(_d(c)).alias(f"s{i}"),
                 F.min(_d(c)).alias(f"lo{i}"), F.max(_d(c)).alias(f"hi{i}")]
    grouped = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("long").alias("count"),
                        F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)]
    return grouped.select(label_col, F.inline(F.array(*structs)))


def correlation_matrix(df: DataFrame, numeric_cols: Sequence[str]) -> DataFrame:
    """Pearson correlation, long form ``col_a, col_b, corr``, every ordered pair including the diagonal.

    Pairwise-complete like pandas: each pair uses the rows where both values are present. A constant column and a pair
    without common rows give NULL, a pair whose common rows have an infinity or NaN gives NaN. Computed from Gram blocks
    (``gram.pair_moments``): one pass whatever the number of columns, no expression per pair.
    """
    m = pair_moments(df, list(numeric_cols))
    spread = F.sqrt(F.col("qa") / F.col("n")) * F.sqrt(F.col("qb") / F.col("n"))
    r = F.when((F.col("n") > 0) & (spread > 0), F.col("c") / F.col("n") / spread)
    return m.select("col_a", "col_b", F.when(F.col("bad") > 0, F.lit(float("nan"))).otherwise(r).alias("corr"))


def outlier_report(df: DataFrame, numeric_cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """C14: per column ``mean, std, threshold (k*std), min, max, outliers`` (beyond mean +- k*std).

    Two jobs for all columns together: a one-row stats aggregate, broadcast to a conditional count.
    """
    cols = list(numeric_cols)
    stats = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(_d(c)).alias(f"m{i}"), F.stddev_samp(_d(c)).alias(f"s{i}"),
        F.min(_d(c)).alias(f"lo{i}"), F.max(_d(c)).alias(f"hi{i}"))])
    flagged = with_scalars(df.select(*cols), stats)
    counts = []
    for i, c in enumerate(cols):
        x, m, t = _d(c), F.col(f"m{i}"), F.col(f"s{i}") * F.lit(float(k))
        counts.append(F.count_if((x > m + t) | (x < m - t)).alias(f"o{i}"))
    for i, _ in enumerate(cols):
        counts += [F.first(f"m{i}").alias(f"m{i}"), F.first(f"s{i}").alias(f"s{i}"),
                   F.first(f"lo{i}").alias(f"lo{i}"), F.first(f"hi{i}").alias(f"hi{i}")]
    row = flagged.agg(*counts)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                        (F.col(f"s{i}") * F.lit(float(k))).alias("threshold"), F.col(f"lo{i}").alias("min"),
                        F.col(f"hi{i}").alias("max"), F.col(f"o{i}").cast("long").alias("outliers"))
               for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*structs)))


def grouped_round_avg(df: DataFrame, value_col: str, group_col: str, digits: int = 2,
                      out_col: str = "avg_value") -> DataFrame:
    """``round(avg(value), digits)`` per group."""
    return df.groupBy(group_col).agg(F.round(F.avg(_d(value_col)), digits).alias(out_col)).select(out_col, group_col)


def num_classes(df: DataFrame, label_col: str) -> DataFrame:
    """Number of distinct labels, NULL counted as one, like ``select(label).distinct().count()``."""
    has_null = F.coalesce(F.max(F.col(label_col).isNull().cast("int")), F.lit(0))
    return df.agg((F.count_distinct(label_col) + has_null).cast("long").alias("num_classes"))
