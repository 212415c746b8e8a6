"""Moments of every pair of columns from Gram blocks.

A task turns its Arrow batches into masked matrices: with the values X (0 where missing) and the mask of present values M,
M'M are the rows of each pair, X'M the sums of a column over the rows of each pair, X'X the products. The means and
centred moments of batches merge pair by pair without cancellation, first in the task, then a matrix row at a time over
groups of tasks, so no expression is compiled per pair and no task gets more than a row of every task's matrices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

#: Per pair (i, j), over its common rows: their number, those with a value that is not finite, the means of i and of j,
#: the squared deviations of i and of j, and the products of their deviations.
MOMENTS = ["n", "bad", "ma", "mb", "qa", "qb", "c"]
#: Rows of a matrix that are merged in one group of the first round: that of tasks modulo this.
MERGE_GROUPS = 256


def _batch_moments(x: np.ndarray, present: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Moments (7 x k x k) of a batch; ``shift`` is a typical value of each column."""
    bad = present & ~np.isfinite(x)
    mask = present.astype(float)
    x = np.where(present & ~bad, x - shift, 0.0)
    n = mask.T @ mask
    total, square, cross = x.T @ mask, (x * x).T @ mask, x.T @ x
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(n > 0, total / n, 0.0)
    q = np.maximum(square - n * mean * mean, 0.0)
    wrong = bad.astype(float).T @ mask
    return np.array([n, wrong + wrong.T, mean + shift[:, None], (mean + shift[:, None]).T, q, q.T, cross - n * mean * mean.T])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of the rows of both: of arrays with the seven moments as first axis."""
    n = a[0] + b[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(n > 0, b[0] / n, 0.0)
    both = a[0] * share
    da, db = np.where(a[0] > 0, b[2] - a[2], 0.0), np.where(a[0] > 0, b[3] - a[3], 0.0)
    ma = np.where(a[0] > 0, a[2] + da * share, b[2])
    mb = np.where(a[0] > 0, a[3] + db * share, b[3])
    return np.array([n, a[1] + b[1], ma, mb, a[4] + b[4] + da * da * both, a[5] + b[5] + db * db * both,
                     a[6] + b[6] + da * db * both])


def _rows(keys: dict[str, pa.Array], moments: np.ndarray) -> pa.RecordBatch:
    """A row per matrix row: the keys and seven lists."""
    count, width = moments.shape[1:]
    offsets = pa.array(np.arange(count + 1, dtype=np.int32) * width)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m).ravel())) for m in moments]
    return pa.RecordBatch.from_arrays([*keys.values(), *lists], [*keys, *MOMENTS])


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``col_a, col_b`` and ``MOMENTS`` for every ordered pair of ``columns`` (``n = 0`` where there are no common rows).

    NULLs are missing; NaN and infinities count as ``bad`` and are left out of the sums."""
    names, k = list(columns), len(columns)
    wide = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)])
    fields = [StructField(m, ArrayType(DoubleType())) for m in MOMENTS]

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            x = np.column_stack([c.fill_null(0.0).to_numpy() for c in batch.columns])
            first = np.argmax(present & np.isfinite(x), axis=0)
            typical = x[first, np.arange(k)]
            shift = np.where(np.isfinite(typical), typical, 0.0)
            found = _batch_moments(x, present, shift)
            held = found if held is None else merge(held, found)
        if held is not None:
            yield _rows({"i": pa.array(np.arange(k, dtype=np.int32))}, held)

    def merged(keys: tuple, table: pa.Table) -> pa.Table:
        parts = np.array([table[m].combine_chunks().flatten().to_numpy().reshape(-1, k) for m in MOMENTS])
        total = parts[:, :1]
        for r in range(1, parts.shape[1]):
            total = merge(total, parts[:, r:r + 1])
        return pa.Table.from_batches([_rows({"i": pa.array([keys[0].as_py()], pa.int32())}, total)])

    schema = StructType([StructField("i", IntegerType()), *fields])
    tasks = wide.mapInArrow(grams, schema).withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    some = tasks.groupBy("i", "slot").applyInArrow(merged, schema)
    rows = some.groupBy("i").applyInArrow(merged, schema)
    labels = F.array(*[F.lit(c) for c in names])
    zipped = F.arrays_zip(labels.alias("col_b"), *MOMENTS)
    spark = df.sparkSession
    every = spark.range(k).select(F.col("id").cast("int").alias("i"))
    filled = every.join(rows, "i", "left").select(
        F.get(labels, F.col("i")).alias("col_a"),
        F.when(F.col("n").isNull(), F.arrays_zip(labels.alias("col_b"), *[F.array_repeat(F.lit(0.0), k).alias(m) for m in MOMENTS]))
        .otherwise(zipped).alias("z"))
    return filled.select("col_a", F.inline("z"))
