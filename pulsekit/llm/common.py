"""Helpers that the operators of this subpackage share: Arrow word splitting, bounded blocks, shared-folder tables."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one step of a Python task works on at a time. A single longer text is a block of its own. Steps that
#: look up distinct words in a table take larger blocks, in which a word repeats more often.
BLOCK_BYTES = 4 << 20
LOOKUP_BLOCK_BYTES = 8 << 20
#: Rows and bytes of an Arrow batch between the executor and its Python workers.
BATCH_ROWS, BATCH_BYTES = 4096, "16m"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def bounded_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to sizes of which an executor can hold one per core twice over."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def trim_memory() -> None:
    """Gives what Arrow and the allocator hold but don't use back."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not a GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def release_memory() -> None:
    """Gives back what earlier tasks left, since Python workers live on between them."""
    gc.collect()
    trim_memory()


#: What this Python worker keeps between tasks, by the operator that made it.
_KEPT: dict[str, dict[str, object]] = {}


def kept(owner: str, key: str, make: Callable[[], object]) -> object:
    """``make()``, made once and kept for later tasks of this owner. What other owners kept goes: workers outlive stages."""
    for other in _KEPT.keys() - {owner}:
        del _KEPT[other]
    own = _KEPT.setdefault(owner, {})
    if key not in own:
        own[key] = make()
    return own[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Only Spark opens the path, so any store that Spark reads will do."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables that this driver has written, with their folders.
_WRITTEN: dict[DataFrame, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which driver and executors share.

    Without that setting a temporary folder takes its place, but only where driver and executors are one process
    (tests, a laptop): on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="pulsekit-shared-")
    return f"{base.rstrip('/')}/pulsekit-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back: cuts lineage, survives a lost executor."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[table] = path
    return table


def _remove(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))


def release(*tables: DataFrame) -> None:
    """Removes materialized tables that no result reads any more: what was made of them has been written itself."""
    for table in tables:
        _remove(table.sparkSession, _WRITTEN.pop(table))


def drop_materialized(spark: SparkSession) -> int:
    """Removes the tables that ``materialize`` wrote for this driver, once no result needs them any more."""
    dropped = 0
    while _WRITTEN:
        dropped += _remove(spark, _WRITTEN.popitem()[1])
    return dropped


def blocks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices the batches so that a slice holds at most ``max_bytes`` of ``column`` (or one longer row).

    Memory that earlier tasks left in this worker is released first, and what the work on a slice left before the next.
    """
    release_memory()
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            trim_memory()
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column as large strings, null as the empty text. Copied: Arrow's ``ascii_lower`` misreads a slice."""
    sliced = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    return pa.concat_arrays([sliced, pa.array([], pa.large_string())])


def drop_empty(parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Of a list array of strings: the non-empty strings in one array, and where each list starts and ends in it."""
    flat = parts.flatten()
    ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return flat.filter(full), kept[ends]


def words_of(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (A-Z lower-cased on request), flat, with the offsets of each text."""
    return drop_empty(pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts))


def coded(flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct strings and each string's index in them."""
    encoded = flat.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def ascii_lower(col):
    """Lower-cases A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
