"""Ordered statistics without a single giant sort task.

``cumulative_by_value`` gives, for every distinct value in every group, the running totals of weight columns over the
group's values up to and including it. The work is spread over ``num_partitions`` tasks even when one group holds
most of the data:

1. ``groupBy(group, value)`` with map-side partial aggregation collapses duplicates before any shuffle, so a value
   repeated a billion times costs one row.
2. ``repartitionByRange(group, value)`` cuts the distinct rows into contiguous, roughly equal key ranges; the result
   is checkpointed to the cluster's ``spark.checkpoint.dir`` so the range ids read below are fixed (and lineage is
   cut: a lost executor does not recompute the inputs).
3. Per range partition and group, a small totals table (at most ``partitions + groups`` rows; AQE broadcasts it
   once it has measured it) gives each partition the sum of everything before it.
4. A running window inside each (partition, group) slice adds that offset.

Both KS statistics and the exact AUC are built on it. Exact quantiles need no order of all values: ``quantile_disc``
selects them by radix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField,
                               StructType)

from ..session import ensure_checkpoint_dir

PART_COL = "_range_part"


def cumulative_by_value(df: DataFrame, group_cols: Sequence[str], value_col: str, weight_cols: Sequence[str],
                        num_partitions: int | None = None, prefix: str = "cum_") -> DataFrame:
    """One row per (group, value): the summed weights, their running totals ``<prefix><weight>`` and the group's
    grand totals ``total_<weight>`` (taken from the small offsets table, so callers need no second scan).

    Rows with a NULL value should be removed by the caller; NULL weights count as 0.
    """
    group_cols = list(group_cols)
    weight_cols = list(weight_cols)

    distinct = df.groupBy(*group_cols, value_col).agg(
        *[F.coalesce(F.sum(w), F.lit(0)).alias(w) for w in weight_cols])
    order = [*[F.col(c).asc() for c in group_cols], F.col(value_col).asc()]
    # Without an explicit count the range shuffle starts at spark.sql.shuffle.partitions and AQE may merge
    # neighbouring ranges of a small input; merged ranges stay contiguous, and the ids are pinned below.
    ranged = distinct.repartitionByRange(int(num_partitions), *order) if num_partitions \
        else distinct.repartitionByRange(*order)
    ranged = ranged.withColumn(PART_COL, F.spark_partition_id())
    # The range id is read twice below (totals and running sums). Each read of an un-materialised range exchange may
    # sample different bounds or coalesce differently, so the ids are pinned by a reliable checkpoint in the
    # cluster's checkpoint folder; that also cuts the lineage, so a lost executor does not recompute the inputs.
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)

    totals = ranged.groupBy(PART_COL, *group_cols).agg(*[F.sum(w).alias(w) for w in weight_cols])
    before = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))) \
        .orderBy(PART_COL).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    offsets = totals.select(PART_COL, *group_cols,
                            *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"_off_{w}") for w in weight_cols],
                            *[F.sum(w).over(whole).alias(f"total_{w}") for w in weight_cols])

    running = Window.partitionBy(PART_COL, *group_cols).orderBy(value_col) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # offsets has at most partitions + groups rows; no hint, AQE broadcasts it after measuring it.
    joined = ranged.join(offsets, [PART_COL, *group_cols], "inner")
    return joined.select(
        *group_cols, value_col, *weight_cols,
        *[(F.col(f"_off_{w}") + F.sum(w).over(running)).alias(f"{prefix}{w}") for w in weight_cols],
        *[f"total_{w}" for w in weight_cols])


MAX_BROADCAST_ROWS = 100_000

#: Bits of a value's image that a round of the radix selection decides, and rows that a task holds before it sends on.
RADIX_BITS = 16
HELD_CELLS = 1 << 18

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def ordered_image(values: pa.Array) -> np.ndarray:
    """64-bit integers in the order of the values: integers as they are; of doubles the bits, those of negative numbers
    turned round. -0.0 counts as 0.0 and every NaN as the one that is above infinity, as in Spark's order."""
    x = values.to_numpy(zero_copy_only=False)
    if x.dtype.kind != "f":
        return x.astype(np.int64)
    x = x.astype(np.float64) + 0.0
    bits = np.where(np.isnan(x), np.nan, x).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def image_values(image: np.ndarray, is_float: bool) -> np.ndarray:
    """The values of ``ordered_image``."""
    return (image ^ ((image >> 63) & np.int64(2**63 - 1))).view(np.float64) if is_float else image


def _radix_cells(groups: Sequence[str], shift: int):
    """Counts of the values by group and by the image's bits from ``shift`` on, of those that have the group's prefix."""
    keys = [*groups, "_cell"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by(keys).aggregate([("_n", "sum")]).select([*keys, "_n_sum"]).rename_columns([*keys, "_n"])

        for batch in batches:
            image = ordered_image(batch.column("_v"))
            cell = image >> shift
            if "_prefix" in batch.schema.names:
                chosen = (cell >> RADIX_BITS) == batch.column("_prefix").to_numpy()
                batch, cell = batch.filter(pa.array(chosen)), cell[chosen] & ((1 << RADIX_BITS) - 1)
            if not batch.num_rows:
                continue
            table = pa.table([*[batch.column(g) for g in groups], pa.array(cell), pa.array(np.ones(len(cell), np.int64))], [*keys, "_n"])
            held.append(table.group_by(keys).aggregate([("_n", "sum")]).select([*keys, "_n_sum"]).rename_columns([*keys, "_n"]))
            size += held[-1].num_rows
            if size > HELD_CELLS:
                held = [merged()]
                size = held[0].num_rows
                if size > HELD_CELLS:  # of many groups
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from merged().combine_chunks().to_batches()

    return count


def quantile_disc(df: DataFrame, group_cols: Sequence[str], value_col: str, probability: float = 0.5,
                  num_partitions: int | None = None, out_col: str = "quantile",
                  bracket_accuracy: int | None = 10000, max_groups: int | None = None) -> DataFrame:
    """Exact discrete quantile per group: the smallest value whose cumulative share reaches ``probability``.

    Same definition as SQL ``percentile_disc``; NULL values are ignored, a NULL group is a group, and groups with no
    values yield no row. The result has the column's type: infinities, NaN (above all) and large integers are values
    like any other.

    Numbers are selected by radix: each value has a 64-bit image of the same order, and four passes each decide 16 bits
    of the answer's image from a histogram of the values that share the bits known so far. The histograms (65,536 cells
    a group at most) are summed in the tasks before they are shuffled; no value is sorted or shuffled, and nothing
    depends on an estimate. Other types (and ``bracket_accuracy=None``, cheaper where there are few distinct values)
    rank every distinct value.

    ``max_groups``: a bound on the number of groups known to the caller (e.g. the number of unpivoted columns). Up to
    ``MAX_BROADCAST_ROWS`` the groups' prefixes (a row each) go through the driver and are broadcast; without a bound
    they are checkpointed and joined.
    """
    group_cols = list(group_cols)
    p = float(probability)
    kind = df.schema[value_col].dataType
    base = df.where(F.col(value_col).isNotNull()).select(*group_cols, F.col(value_col).alias("_v"))
    if bracket_accuracy is None or not isinstance(kind, (*_INTEGRAL, FloatType, DoubleType)):
        cum = cumulative_by_value(base.withColumn("_w", F.lit(1).cast("long")), group_cols, "_v", ["_w"],
                                  num_partitions)
        reached = cum.where(F.col("cum__w") >= F.lit(p) * F.col("total__w"))
        return reached.groupBy(*group_cols).agg(F.min("_v").alias(out_col))
    spark = df.sparkSession
    bounded = not group_cols or (max_groups is not None and max_groups <= MAX_BROADCAST_ROWS)
    group_fields = [df.schema[g] for g in group_cols]
    cells_schema = StructType([*group_fields, StructField("_cell", LongType()), StructField("_n", LongType())])
    by_group = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    up_to = by_group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = None
    for shift in range(64 - RADIX_BITS, -1, -RADIX_BITS):
        rows = base
        if state is not None:
            renamed = state.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(group_cols)], "_prefix")
            same = [F.col(g).eqNullSafe(F.col(f"_g{k}")) for k, g in enumerate(group_cols)]
            rows = (base.join(F.broadcast(renamed) if bounded else renamed, same, "inner") if group_cols
                    else base.withColumn("_prefix", F.lit(prefix).cast("long"))).select(*group_cols, "_v", "_prefix")
        cells = rows.mapInArrow(_radix_cells(group_cols, shift), cells_schema) \
            .groupBy(*group_cols, "_cell").agg(F.sum("_n").alias("_n"))
        ranked = cells.withColumn("_cum", F.sum("_n").over(up_to))
        if state is None:
            total = F.sum("_n").over(by_group)
            ranked = ranked.withColumn("_rank", F.greatest(F.ceil(F.lit(p) * total), F.lit(1)).cast("long")).withColumn("_known", F.lit(0).cast("long"))
        elif group_cols:
            names = [f"_g{k}" for k in range(len(group_cols))]
            before = state.select(*[F.col(g).alias(n) for g, n in zip(group_cols, names, strict=True)], "_rank", F.col("_prefix").alias("_known"))
            ranked = ranked.join(F.broadcast(before) if bounded else before,
                                 [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group_cols, names, strict=True)], "inner").drop(*names)
        else:
            ranked = ranked.withColumn("_rank", F.lit(rank).cast("long")).withColumn("_known", F.lit(prefix).cast("long"))
        first = F.min_by(F.struct("_cell", (F.col("_rank") - F.col("_cum") + F.col("_n")).alias("left")), "_cell")
        state = ranked.where("_cum >= _rank").groupBy(*group_cols, "_known").agg(first.alias("_f")).select(
            *group_cols, (F.shiftleft("_known", RADIX_BITS) + F.col("_f._cell")).alias("_prefix"), F.col("_f.left").alias("_rank"))
        if not bounded:
            ensure_checkpoint_dir(spark)
            state = state.checkpoint(eager=True)
            continue
        found = state.collect()  # one row a group, within the bound
        state = spark.createDataFrame(found, state.schema)
        if not found:
            break
        prefix, rank = found[0]["_prefix"], found[0]["_rank"]

    is_float = isinstance(kind, (FloatType, DoubleType))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array(image_values(batch.column("_prefix").to_numpy(), is_float))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], [*batch.schema.names[:-1], "_out"])

    schema = StructType([*group_fields, StructField("_out", DoubleType() if is_float else LongType())])
    return state.select(*group_cols, "_prefix").mapInArrow(values, schema).select(*group_cols, F.col("_out").cast(kind).alias(out_col))


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate result to every row of ``df``.

    The one-row frame becomes a scalar subquery (packed as one struct, so it runs once): Spark evaluates it before
    the main stage and inlines the values, so there is no join, no shuffle of ``df`` and nothing collected here.
    ``one_row`` must produce exactly one row, e.g. a global ``agg``.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_scalars")).scalar()
    return df.withColumn("_scalars", packed) \
        .select(*[F.col(c) for c in df.columns], *[F.col(f"_scalars.{c}").alias(c) for c in cols])
