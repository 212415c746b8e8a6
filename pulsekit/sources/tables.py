"""Table-level sources and sinks.

Operators elsewhere take DataFrames; these helpers are the edges: scanning a catalog table or parquet path with
column pruning, metadata listing, a full-copy snapshot, and key-based upserts of frames and of tables in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scan(spark: SparkSession, source: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A1: a catalog table name or a parquet path; selecting ``columns`` here lets the scan read only those."""
    is_path = "/" in source or source.endswith(".parquet")
    df = spark.read.parquet(source) if is_path else spark.table(source)
    return df.select(*columns) if columns else df


def select_all(spark: SparkSession, table: str) -> DataFrame:
    """A2: ``SELECT * FROM table`` through the SQL parser."""
    return spark.sql(f"SELECT * FROM {table}")


def describe_columns(df: DataFrame) -> DataFrame:
    """A3 for a DataFrame: ``col_name, data_type, nullable`` from its schema (no job runs)."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), bool(f.nullable)) for f in df.schema.fields]
    return spark.createDataFrame(rows, "col_name string, data_type string, nullable boolean")


def describe_table(spark: SparkSession, table: str, extended: bool = True) -> DataFrame:
    """A3 for a catalog table: ``DESCRIBE TABLE [EXTENDED]``."""
    return spark.sql(f"DESCRIBE TABLE {'EXTENDED ' if extended else ''}{table}")


def snapshot(df: DataFrame, target: str, as_table: bool = True, partition_by: Sequence[str] | None = None) -> None:
    """A4: full copy of ``df`` into a table (or a parquet path), replacing it.

    Stock Spark has no metadata-only clone, so this is a distributed rewrite; each task writes its own files.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.parquet(target)


def _one_row_a_key(source: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    twice = F.raise_error(F.lit(f"upsert source has several rows for one key of {list(keys)}"))
    return source.groupBy(*keys).agg(F.first(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_n")) \
        .where(F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(F.lit(True))).select("_row.*")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same key; other target rows stay.

    A key that ``source`` has more than once is an error when the result is computed, as in a merge: which of its rows
    would win isn't defined.

    ``target LEFT ANTI JOIN source_keys`` then ``UNION BY NAME source``: a shuffle join on the keys (AQE turns it
    into a broadcast when the source is small) and no row-level rewrite; write the result to a new location, or keep the
    target as an ``upsert_table``.
    """
    keys = list(keys)
    new = _one_row_a_key(source, target.columns, keys)
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new)


BUCKET = "key_bucket"


def create_keyed_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> None:
    """A parquet table at ``path`` (which must not exist) that ``upsert_table`` changes in place: one folder per bucket of
    the keys' hash. Keys and number of buckets are kept beside the rows. A bucket is written by one task and is what an
    upsert rewrites at least: take as many as make a bucket some hundred MB."""
    keyed = df.withColumn(BUCKET, _bucket_of(keys, buckets))
    keyed.repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)
    df.sparkSession.createDataFrame([(list(keys), buckets)], "keys array<string>, buckets int").coalesce(1).write.json(f"{path}/_layout")


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_keyed_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a keyed table, without its bucket column."""
    return spark.read.parquet(path).drop(BUCKET)


def upsert_table(spark: SparkSession, path: str, source: DataFrame) -> list[int]:
    """A9 in place: rows of ``source`` replace those with the same key in the table at ``path``, others are added.

    Only the buckets that a key of ``source`` falls in are read and written (partition pruning on the way in, dynamic
    partition overwrite on the way out); the files of all others stay as they are. Returns the rewritten buckets, whose
    numbers are all that the driver reads of the data. ``source`` has the table's columns (others are ignored) and is
    computed once; a key that it has twice is an error and nothing is written. A NULL in a key equals nothing: such rows
    are added. New files replace old ones when the job commits; a run that is broken off before can be repeated, since
    an upsert of the same rows changes nothing more. One writer at a time.
    """
    layout = spark.read.json(f"{path}/_layout").first()
    keys, buckets = list(layout["keys"]), int(layout["buckets"])
    table = spark.read.parquet(path)
    columns = [f for f in table.schema.fields if f.name != BUCKET]
    same = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])
    ensure_checkpoint_dir(spark)
    nowhere = F.lit(False)
    for k in keys:
        nowhere = nowhere | F.col(k).isNull()
    new = _one_row_a_key(same.where(~nowhere), [f.name for f in columns], keys).unionByName(same.where(nowhere)) \
        .withColumn(BUCKET, _bucket_of(keys, buckets)).checkpoint(eager=True)
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    if not touched:
        return []
    old = table.where(F.col(BUCKET).isin(touched))
    kept = old.join(new.select(*keys, BUCKET), [*keys, BUCKET], "left_anti")
    kept.unionByName(new).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(BUCKET).parquet(path)
    return touched


def with_changed(df: DataFrame, column: str, delta: float) -> DataFrame:
    """Helper for upsert fixtures: ``column + delta``."""
    return df.withColumn(column, F.col(column) + F.lit(delta))
