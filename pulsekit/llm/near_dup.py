"""Near-duplicate documents: SetSketch registers, bands of them, a joint likelihood estimate, exact confirmation.

The steps, each a Spark job over tables:

1. Every document becomes its set of five-word shingles; documents with the same set are one class, represented by
   its smallest doc_id. Copies end here: they are pre-aggregated before the shuffle and never paired.
2. The SetSketch registers of a class are cut into bands. Classes that share a band's values point to the smallest
   class of that band (a star, not pairs), and the components of these pointers are families: two classes with a
   common band are always in one family.
3. A family's members are split into blocks of a bounded number of bytes and rows. Members with the same smallest hub
   go side by side, so that a band meets few blocks. Blocks with a common band are one unit of work per pair: register
   pairs are compared as matrices, the maximum-likelihood estimate prunes, and the full sets confirm. Only links that
   join two so far unconnected members are returned, so that the links grow with members, not with pairs.
4. The components of the links give component_id.

Recall: with 42 bands of 6 registers a pair at similarity 0.80 shares no band with a probability of 3e-6, at 0.85 of
2e-9; at 0.5 it shares one with 48 %, at 0.3 with 3 %, so that families are not chains of loosely similar texts. The
estimate's standard error is at most 0.025 at 0.80; pairs are confirmed from 0.13 (five standard errors) below the
threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import blocks, fresh, materialize, release, release_memory, texts_of
from pulsekit.llm.components import connected_components
from pulsekit.llm.shingles import M, joint_estimate, registers, shingle_sets

BAND_REGISTERS = 6
#: A block of a family holds about so many bytes of shingle hashes and registers, and so many rows; a unit of work holds two.
BLOCK_SET_BYTES, BLOCK_ROWS = 2 << 20, 1024
ESTIMATE_MARGIN = 0.13

_SKETCH = "rid long, doc_id long, n_shingles long, set_key binary, regs binary"
_SETS = "doc_id long, set_key binary, hashes binary"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches, "text"):
        sets = shingle_sets(texts_of(part))
        yield pa.RecordBatch.from_arrays([
            part.column("rid"), part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
        ], names=["rid", "doc_id", "n_shingles", "set_key", "regs"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches, "text"):
        sets = shingle_sets(texts_of(part))
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id"),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array([s.tobytes() for s in sets], pa.binary()),
        ], names=["doc_id", "set_key", "hashes"])


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _links_of_unit(ids, sides, sets, regs, percent: int) -> list[tuple[int, int]]:
    """Links that connect members of one pair of blocks: a forest over them, not all linked pairs.

    ``sides`` tells each member's block. Within one block all pairs count (both sides 0), else only pairs across.
    """
    n = len(ids)
    sizes = np.array([len(s) for s in sets], np.float64)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links, crossing = [], bool(sides.any())
    floor = percent / 100 - ESTIMATE_MARGIN
    order = np.argsort(sizes, kind="stable")
    sorted_sizes = sizes[order]
    for at in range(1, n):
        i = int(order[at])
        # partners that are not larger, and large enough: similarity is at most the ratio of the sizes
        start = int(np.searchsorted(sorted_sizes, sizes[i] * percent / 100 * (1 - 1e-9)))
        js = order[start:at]
        if crossing:
            js = js[sides[js] != sides[i]]
        if not len(js):
            continue
        equal = (regs[js] == regs[i]).sum(axis=1)
        js = js[equal >= M * (floor - 0.02)]  # the likelihood estimate is about the share of equal registers
        if not len(js):
            continue
        estimate = joint_estimate(regs[js], np.broadcast_to(regs[i], (len(js), M)), sizes[js], np.full(len(js), sizes[i]))
        passed = estimate >= floor
        js, estimate = js[passed], estimate[passed]
        for j in js[np.argsort(-estimate, kind="stable")].tolist():
            a, b = root(i), root(j)
            if a == b:
                continue
            both = _overlap(sets[i], sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[max(a, b)] = min(a, b)
                links.append((int(ids[i]), int(ids[j])))
    return links


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit; a unit is complete when the next one begins."""
        release_memory()
        held: list[pa.RecordBatch] = []
        unit = None

        def finish() -> pa.RecordBatch | None:
            members = pa.Table.from_batches(held)
            sets = [np.frombuffer(h, np.uint64) for h in members.column("hashes").to_pylist()]
            regs = np.frombuffer(b"".join(members.column("regs").to_pylist()), np.uint16).reshape(-1, M)
            found = _links_of_unit(members.column("rep").to_numpy(), members.column("side").to_numpy(), sets, regs, percent)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                               pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("x", "y")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if hi <= lo:
                    continue
                now = tuple(keys[:, lo].tolist())
                if held and now != unit:
                    yield finish()
                    held = []
                unit = now
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield finish()

    return confirm


def _blocks(classes: DataFrame, families: DataFrame, shared: DataFrame) -> DataFrame:
    """Members (set_key, rep, regs) with the block each belongs to, and the number of bins of its family.

    The members of a smallest hub are a cell. Cells go to bins by hash, as many as the family's size asks for; a cell
    beyond a block's size is cut by its members' hashes into blocks of its own.
    """
    anchors = shared.groupBy("rep").agg(F.min("hub").alias("anchor"))
    members = classes.join(families, "rep").join(anchors, "rep")
    cells = materialize(members.groupBy("family", "anchor").agg(
        F.sum(F.col("n") * 8 + 2 * M).alias("bytes"), F.count(F.lit(1)).alias("rows")))

    def parts(size: Column, rows: Column) -> Column:
        return F.ceil(F.greatest(size / F.lit(BLOCK_SET_BYTES), rows / F.lit(BLOCK_ROWS))).cast("long")

    bins = cells.groupBy("family").agg(parts(F.sum("bytes"), F.sum("rows")).alias("bins"))
    places = (cells.join(bins, "family").withColumn("cuts", parts(F.col("bytes"), F.col("rows")))
              .select("anchor", "family", "bins", "cuts"))
    own = F.xxhash64("anchor", F.pmod(F.xxhash64("rep", F.lit("block")), F.col("cuts")), F.lit("cut"))
    common = F.xxhash64("family", F.pmod(F.xxhash64("anchor", F.lit("bin")), F.col("bins")), F.lit("bin"))
    placed = materialize(members.drop("family").join(places, "anchor")
                         .select("set_key", "rep", "regs", "bins", F.when(F.col("cuts") > 1, own).otherwise(common).alias("block")))
    release(cells)
    return placed


def _units(members: DataFrame, shared: DataFrame) -> DataFrame:
    """The units (x, y) each block takes part in, with its side: itself, and every block that it has a band in common with."""
    touched = materialize(members.where("bins > 1").select("rep", "block").distinct().join(shared.select("rep", "band"), "rep")
                          .select("band", "block").distinct())
    crossing = (touched.withColumnRenamed("block", "x").join(touched.withColumnRenamed("block", "y"), "band")
                .where("x < y").select("x", "y").distinct())
    pairs = members.select(F.col("block").alias("x"), F.col("block").alias("y")).distinct().unionByName(crossing)
    left, right = F.struct(F.col("x").alias("block"), F.lit(0).alias("side")), F.struct(F.col("y").alias("block"), F.lit(1).alias("side"))
    ends = materialize(pairs.select("x", "y", F.explode(F.when(F.col("x") == F.col("y"), F.array(left))
                                                        .otherwise(F.array(left, right))).alias("e")).select("x", "y", "e.*"))
    release(touched)
    return ends


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Component of every document under "100 * |intersection| >= percent * |union|" of five-word shingle sets.

    ``docs`` needs doc_id (long) and text. Returns one row per input row: doc_id, n_shingles, component_id, kept.
    A null or empty text has no shingles, is linked with nothing and kept. Rows that repeat a doc_id with the same
    text are one document (all are returned and share its verdict). A row without doc_id has component_id null and is
    kept, since no other row can name it. Other columns are ignored.
    """
    return _numbered_components(docs, F.monotonically_increasing_id(), percent)[0].drop("rid")


def _numbered_components(docs: DataFrame, rid: Column, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """The components with a row number, which is read from ``docs`` in the first pass only, and the tables they read."""
    source = docs.select(rid.alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = materialize(source.mapInArrow(_sketches, _SKETCH))
    classes = materialize(sketched.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key")
                          .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs")))

    # Bands: a star to the smallest class of each band value.
    width = 2 * BAND_REGISTERS
    bands = classes.select("rep", F.explode(F.array([
        F.xxhash64(F.lit(k), F.expr(f"substring(regs, {1 + k * width}, {width})"))
        for k in range(M // BAND_REGISTERS)])).alias("band"))
    hubs = bands.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last")
    shared = materialize(bands.join(hubs, "band").select("band", "rep", "hub"))
    stars = shared.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    families = connected_components(stars).withColumnsRenamed({"node": "rep", "component": "family"})
    members = _blocks(classes, families, shared)
    ends = _units(members, shared)

    # Full sets of the members only, from their texts, to each unit of their block.
    # As a table the ids have a known size: few of them are broadcast by Spark's own threshold, and no text is shuffled.
    wanted = materialize(members.select(F.col("rep").alias("doc_id")).distinct())
    texts = source.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    sets = texts.mapInArrow(_full_sets, _SETS).dropDuplicates(["doc_id", "set_key"])
    sets = materialize(members.withColumnRenamed("rep", "doc_id").join(sets, ["doc_id", "set_key"])
                       .select(F.col("doc_id").alias("rep"), "block", "regs", "hashes"))
    units = sets.join(ends, "block").select("x", "y", "side", "rep", "regs", "hashes")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = (units.repartition(n, "x", "y").sortWithinPartitions("x", "y")
             .mapInArrow(_confirm(percent), "a long, b long"))
    components = connected_components(links).withColumnsRenamed({"node": "rep"})
    release(sets, wanted, ends, members, shared)

    resolved = classes.select("set_key", "rep").join(components, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("found"))
    found = (sketched.select("rid", "doc_id", "n_shingles", "set_key").join(resolved, "set_key", "left")
             .select("rid", "doc_id", "n_shingles",
                     F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))
             .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
    return found, [sketched, classes]


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each near-duplicate group of docs, all columns unchanged: of the rows of the kept doc_id the first.

    Rows without doc_id and rows without words stay, an empty table gives an empty table. The numbered rows are written
    once and verdict and result read that table, since two reads of ``docs`` may number its rows differently.
    """
    rid, gone = fresh(docs, "rid"), fresh(docs, "dropped")
    numbered = materialize(docs.withColumn(rid, F.monotonically_increasing_id()))
    found, read = _numbered_components(numbered, F.col(rid), percent)
    verdict = materialize(found)
    release(*read)
    first = verdict.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("rid").alias("first"))
    dropped = (verdict.where("doc_id IS NOT NULL").join(first, "doc_id", "left")
               .where("NOT kept OR rid <> first").select(F.col("rid").alias(gone)))
    return numbered.join(materialize(dropped), F.col(rid) == F.col(gone), "left_anti").drop(rid)
