"""Shards by extendible hashing: buckets split on one more hash bit until each fits its byte limit.

The directory is a table over hash prefixes, built from sums per prefix and never from rows: rows are first summed per
deep prefix, and the sums decide how many bits each bucket needs. Repeated keys can't overfill a bucket: the hash is
of the key and of the row's content, and rows that are the same throughout get numbers of their own as a salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import fresh, materialize

#: Bits that one step of the directory looks at; a bucket that still doesn't fit takes part in the next step.
STEP_BITS = 8
MAX_BITS = 64


def _bits(col):
    """The first 64 bits of an MD5 digest as a string of 0 and 1: a prefix of it is a directory entry."""
    return F.concat(*(F.lpad(F.conv(F.substring(col, 1 + 8 * k, 8), 16, 2), 32, "0") for k in range(2)))


def shard_documents(docs: DataFrame, max_bytes: int) -> DataFrame:
    """Assigns every document (doc_id, text; other columns are ignored) to a shard of at most ``max_bytes`` of UTF-8.

    Returns one row per input row: doc_id, n_bytes, shard (the hash-prefix bits, its place in the directory), depth
    (their number), shard_bytes, over_limit (a single document that is longer than the limit: it fills a shard that no
    splitting can shrink). A null text has 0 bytes. Rows that repeat a doc_id are hashed with their text and, where that repeats
    too, with their number, so that they spread; a null doc_id is a key like any other.
    """
    return _numbered_shards(docs, F.monotonically_increasing_id(), max_bytes).drop("rid")


def write_shards(docs: DataFrame, path: str, max_bytes: int) -> DataFrame:
    """Writes docs, all columns, as Parquet below ``path`` with a folder ``shard=<bits>`` for each shard (the column gets
    another name if docs has one of this), and returns the assignment as ``shard_documents`` does.

    A shard is written by one task, which its limit bounds; only a document over the limit makes a larger one. The
    numbered rows are written once before, so that rows and assignment are of one read.
    """
    rid, shard = fresh(docs, "rid"), fresh(docs, "shard")
    numbered = materialize(docs.withColumn(rid, F.monotonically_increasing_id()))
    assigned = materialize(_numbered_shards(numbered, F.col(rid), max_bytes))
    placed = assigned.select(F.col("rid").alias(rid), F.concat(F.lit("b"), "shard").alias(shard))  # the root's bits are empty
    numbered.join(placed, rid).drop(rid).repartition(shard).write.partitionBy(shard).parquet(path)
    return assigned.drop("rid")


def _numbered_shards(docs: DataFrame, rid: Column, max_bytes: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                    F.md5(key).alias("key"), F.md5(text).alias("content"), rid.alias("rid")))
    # Keys that occur once, nearly all, are hashed by key alone; the others are salted.
    repeated = rows.groupBy("key").agg(F.count("*").alias("uses")).where("uses > 1").select("key", F.lit(True).alias("again"))
    salted = F.md5(F.concat("key", "content", F.col("rid").cast("string")))
    placed = materialize(rows.join(repeated, "key", "left").select(
        "rid", "doc_id", "n_bytes", _bits(F.when(F.col("again"), salted).otherwise(F.col("key"))).alias("bits")))

    directory, open_buckets, depth = None, None, 0
    while depth < MAX_BITS:
        deeper = depth + STEP_BITS
        live = placed if open_buckets is None else placed.join(
            open_buckets, F.substring("bits", 1, depth) == F.col("bucket"), "left_semi")
        sums = materialize(live.groupBy(F.substring("bits", 1, deeper).alias("prefix"))
                           .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")))
        levels = sums.select("bytes", "n", F.explode(F.expr(
            f"transform(sequence({depth}, {deeper}), d -> struct(d AS depth, substring(prefix, 1, d) AS bucket))")).alias("x"))
        totals = levels.groupBy("x.depth", "x.bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        # a bucket of the directory is the shortest prefix that fits; one document alone always does, and all bits do
        fits = materialize(totals.withColumn(
            "fits", (F.col("bytes") <= max_bytes) | (F.col("n") == 1) | (F.col("depth") == MAX_BITS)))
        parent = fits.where("NOT fits").select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"))
        leaves = (fits.where("fits").withColumn("parent", F.expr("substring(bucket, 1, greatest(depth - 1, 0))"))
                  .join(parent, ["depth", "parent"], "left_semi").select("bucket", "depth", "bytes"))
        if depth == 0:
            leaves = leaves.union(fits.where(F.col("fits") & (F.col("depth") == 0)).select("bucket", "depth", "bytes"))
        directory = leaves if directory is None else directory.union(leaves)
        open_buckets = materialize(fits.where(~F.col("fits") & (F.col("depth") == deeper)).select("bucket"))
        depth = deeper
        if open_buckets.isEmpty():
            break
    directory = materialize(directory)
    depths = [r["depth"] for r in directory.select("depth").distinct().orderBy("depth").collect()]  # at most MAX_BITS
    prefixes = [F.substring("bits", 1, d) for d in depths] or [F.lit("")]  # no depth: no rows
    tried = placed.withColumn("bucket", F.explode(F.array(*prefixes)))
    return tried.join(directory, "bucket").select(
        "rid", "doc_id", "n_bytes", F.col("bucket").alias("shard"), "depth", F.col("bytes").alias("shard_bytes"),
        (F.col("bytes") > max_bytes).alias("over_limit"))
