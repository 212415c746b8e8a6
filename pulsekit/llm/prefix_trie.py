"""The trie of conversations: which conversations start with the same turns, and what that saves.

Turns are hashed to ids where they are read, so that texts are never shuffled. Conversations become pieces of a bounded
number of turns; each task puts its pieces into adaptive radix trees (``radix_tree``) over fixed-width big-endian turn
ids and emits one row for each turn-aligned depth, with what its own conversations add to that trie node. The rows of
one trie node are then summed by the node's key. No conversation and no node is ever collected whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import bounded_batches, materialize, release_memory
from pulsekit.llm.radix_tree import RadixTree

#: Turns of a piece, turns of the pieces that one radix tree holds, conversation ids in one row of an id list.
PIECE_TURNS = 256
TREE_TURNS = 1 << 17
CHUNK_IDS = 1 << 14
#: Bytes of a turn id in a radix tree: a tree numbers its own distinct turns.
ID_BYTES = 4

_NODES = ("depth long, z1 long, z2 long, p1 long, p2 long, conv_id long, before long, n long, n_ended long, n_own long, "
          "n_bytes long, n_children long, n_leaves long, saved long")


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, tid (16 bytes of the SHA-256 of role and text), n_bytes of the text; without null conv_ids."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    tid = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", tid.alias("tid"),
        F.octet_length(text).cast("long").alias("n_bytes"))


def positioned_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0, by turn with null first, then tid), tid, n_bytes.

    The rows are dealt out in ranges of (conv_id, turn, tid), and equal ones by a random number, so that one long
    conversation is spread like any other. Each task counts from 0; a conversation that goes on from an earlier range
    gets what came before from a table of one row for each range at most.
    """
    salt = F.rand(13)  # only among rows that are equal
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("tid").asc()]
    ranged = turns.repartitionByRange(*order, salt).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("part"), "conv_id", "tid", "n_bytes")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy()
            starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            rank = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
            if conv[0] == last:
                rank[:starts[1] if len(starts) > 1 else len(conv)] += seen
            last, seen = conv[-1], int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank, pa.int64())], [*batch.schema.names, "rank"])

    ranked = materialize(ranged.mapInArrow(counted, "part int, conv_id long, tid binary, n_bytes long, rank long"))
    held = ranked.groupBy("conv_id", "part").agg(F.count("*").alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.withColumn("carried", F.sum("held").over(earlier)).where("carried > 0").select("conv_id", "part", "carried")
    # Only the first conversation of a range can have rows in an earlier one: as many rows as there are ranges at most.
    return ranked.join(F.broadcast(carried), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("rank") + F.coalesce("carried", F.lit(0))).alias("pos"), "tid", "n_bytes")


def rebuilt_pieces(turns: DataFrame, family: int, most_shared: int, piece_turns: int) -> DataFrame:
    """Pieces of the rebuilt conversations: conv_id, piece (from 0), depth before it, is_last, turns (tid, n_bytes, z1, z2).

    z1 and z2 hash a turn with its place; the exclusive or of a sequence's is the key of its trie node.
    """
    shared = (F.crc32(F.col("conv_id").cast("string")) % (most_shared + 1)).cast("int")
    entry = F.struct("pos", "tid", "n_bytes")
    own = turns.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.when(F.col("pos") < most_shared, entry))).alias("opening"))  # most_shared at most
    bases = own.select(F.col("conv_id").alias("base"), F.col("opening").alias("lent"))
    convs = (own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
                        F.greatest(F.col("n_turns") - shared, F.lit(0)).alias("n_rest"))
             .join(bases, "base", "left")  # a base has family - 1 others at most on either side of 0
             .select("conv_id", "n_rest", F.coalesce(F.slice("lent", F.lit(1), shared), F.expr("slice(lent, 1, 0)"),
                                                     F.array().cast("array<struct<pos:bigint,tid:binary,n_bytes:bigint>>")).alias("head")))
    rest = (turns.where(F.col("pos") >= shared)
            .groupBy("conv_id", F.floor((F.col("pos") - shared) / piece_turns).alias("piece"))
            .agg(F.array_sort(F.collect_list(entry)).alias("turns")))  # piece_turns at most
    cut = rest.join(convs, "conv_id").unionByName(
        convs.where("n_rest = 0").select("conv_id", F.lit(0).cast("long").alias("piece"), F.expr("slice(head, 1, 0)").alias("turns"),
                                         "n_rest", "head"))
    depth = F.when(F.col("piece") == 0, 0).otherwise(F.size("head") + F.col("piece") * piece_turns)
    joined = cut.select("conv_id", "piece", depth.cast("long").alias("depth"),
                        ((F.col("piece") + 1) * piece_turns >= F.col("n_rest")).alias("is_last"),
                        F.when(F.col("piece") == 0, F.concat("head", "turns")).otherwise(F.col("turns")).alias("turns"))

    def placed(z: int) -> str:
        return f"xxhash64({z}, depth + k, t.tid)"

    return joined.select("conv_id", "piece", "depth", "is_last", F.expr(
        f"transform(turns, (t, k) -> named_struct('tid', t.tid, 'n_bytes', t.n_bytes, 'z1', {placed(1)}, 'z2', {placed(2)}))"
    ).alias("turns"))


def opened_pieces(pieces: DataFrame) -> DataFrame:
    """The pieces with what comes before them: z1, z2 and n_before (bytes); and total, the conversation's bytes."""
    summed = pieces.select("conv_id", "piece", F.expr("aggregate(turns, 0L, (a, t) -> a + t.n_bytes)").alias("bytes"),
                           *[F.expr(f"aggregate(turns, 0L, (a, t) -> a ^ t.z{k})").alias(f"x{k}") for k in (1, 2)],
                           (F.col("piece") == 0).alias("is_first"), "is_last")
    # Conversations of more than one piece: one row per piece, without its turns.
    several = summed.where("NOT (is_first AND is_last)")
    order = Window.partitionBy("conv_id").orderBy("piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = several.select("conv_id", "piece", *[F.coalesce(F.expr(f"bit_xor(x{k})").over(before), F.lit(0)).alias(f"s{k}") for k in (1, 2)],
                            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("n_before"),
                            F.sum("bytes").over(Window.partitionBy("conv_id")).alias("total"))
    zero = F.lit(0).cast("long")
    return pieces.join(starts, ["conv_id", "piece"], "left").select(
        *pieces.columns, *[F.coalesce(f"s{k}", zero).alias(f"s{k}") for k in (1, 2)],
        F.coalesce("n_before", zero).alias("n_before"),
        F.coalesce("total", F.expr("aggregate(turns, 0L, (a, t) -> a + t.n_bytes)")).alias("total"))


def tree_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One radix tree over the batch's pieces; one row per trie node with what these pieces add to it.

    A conversation owns a node if it is the node's smallest member; it then owns all deeper nodes on its way, from depth
    ``owned_from`` (null: none). A node that n conversations pass, one of which may be its owner, adds (n - owners) times
    the bytes of its last text to what its subtree saves. A piece also brings what its conversation adds in later
    pieces: saved_later, leaf, and owns_next for the node after its end.
    """
    conv, depth, s1, s2, before, owned_from, later = (
        batch.column(c).to_numpy() for c in ("conv_id", "depth", "s1", "s2", "n_before", "owned_from", "saved_later"))
    leaf, owns_next, is_last = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "owns_next", "is_last"))
    lists = batch.column("turns")
    flat = lists.flatten()
    tid, sizes, z1, z2 = (flat.field(k) for k in range(4))
    sizes, z1, z2 = sizes.to_numpy(), z1.to_numpy(), z2.to_numpy()
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    # What stands before and after each turn: bytes and keys, from the start of its conversation.
    n_turns = np.diff(ends)
    row = np.repeat(np.arange(len(conv)), n_turns)

    def running(ufunc, values, start):
        total = np.append(0, ufunc.accumulate(values)) if len(values) else np.zeros(1, np.int64)
        inverse = np.subtract if ufunc is np.add else np.bitwise_xor
        return ufunc(inverse(total[1:], total[ends[:-1]][row]), start[row])

    upto, k1, k2 = running(np.add, sizes, before), running(np.bitwise_xor, z1, s1), running(np.bitwise_xor, z2, s2)
    ids = tid.dictionary_encode().indices.to_numpy().astype(f">u{ID_BYTES}").tobytes() if len(flat) else b""
    opening = np.unique(np.stack([depth, s1, s2], 1), axis=0, return_inverse=True)[1].reshape(-1).astype(f">u{ID_BYTES}").tobytes()

    tree = RadixTree()
    for k in range(len(conv)):
        tree.insert(opening[ID_BYTES * k:ID_BYTES * (k + 1)] + ids[ID_BYTES * ends[k]:ID_BYTES * ends[k + 1]], k)

    nodes = tree.nodes()
    # Sums over the pieces that pass a node: n, least row, leaves, saved, owners of the next trie nodes below.
    sums = [[0, -1, 0, 0, 0] for _ in nodes]
    out = []
    for k in range(len(nodes) - 1, -1, -1):
        node, parent, end = nodes[k]
        n, least, leaves, saved, below = sums[k]
        n_ended = 0
        for r in node.values:
            n, leaves, saved, below = n + 1, leaves + int(leaf[r]), saved + int(later[r]), below + int(owns_next[r])
            n_ended += int(is_last[r])
            if least < 0 or conv[r] < conv[least]:
                least = r
        start = nodes[parent][2] if parent >= 0 else 0
        for at in range(end - end % ID_BYTES, max(start, ID_BYTES - 1), -ID_BYTES):
            place = at // ID_BYTES - 1  # turns of the piece up to here
            d = int(depth[least]) + place
            if not place and d:
                break  # the end of the piece before has this node
            turn = int(ends[least]) + place - 1
            own = int(owned_from[least] <= d)
            size = int(sizes[turn]) if place else 0
            saved += (n - own) * size
            out.append((d, turn if place else -1, least, n, n_ended if at == end else 0, own, size, below, leaves, saved))
            below = own
        if parent >= 0:
            total = sums[parent]
            total[0] += n
            total[2] += leaves
            total[3] += saved
            total[4] += below
            if total[1] < 0 or conv[least] < conv[total[1]]:
                total[1] = least
    d, turn, least, n, n_ended, own, size, below, leaves, saved = np.array(out, np.int64).reshape(-1, 10).T
    here, first = turn >= 0, turn == ends[:-1][least]

    def at_turn(values, index, other):
        return np.where(index >= 0, values[index], other) if len(values) else np.broadcast_to(other, index.shape)

    parents = [np.where(first | ~here, s[least], at_turn(key, np.maximum(turn - 1, 0), 0)) for key, s in ((k1, s1), (k2, s2))]
    columns = [d, at_turn(k1, turn, 0), at_turn(k2, turn, 0), *parents, conv[least], at_turn(upto, turn, 0) - size,
               n, n_ended, own, size, below, leaves, saved]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns],
                                      [f.split()[0] for f in _NODES.split(", ")])


def trie_parts(pieces: DataFrame) -> DataFrame:
    """The rows of ``tree_rows`` for trees of at most ``TREE_TURNS`` turns (or one Arrow batch) each."""
    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        held, turns = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                turns += pc.sum(pc.list_value_length(batch.column("turns"))).as_py() or 0
            if turns >= TREE_TURNS:
                yield tree_rows(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, turns = [], 0
        if held:
            yield tree_rows(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return pieces.mapInArrow(grown, _NODES)


def end_digests(pieces: DataFrame) -> DataFrame:
    """depth, z1, z2 of every node at which conversations end, and the SHA-256 of their ids, ascending, comma-joined.

    The ids are sorted in ranges, where a node of very many is spread over tasks and becomes a few rows of joined ids.
    One task then runs over a node's rows in order and keeps the state of the hash only.
    """
    key = ["depth", "z1", "z2"]
    last = pieces.where("is_last").select(
        (F.col("depth") + F.size("turns")).alias("depth"),
        *[F.expr(f"s{k} ^ aggregate(turns, 0L, (a, t) -> a ^ t.z{k})").alias(f"z{k}") for k in (1, 2)], "conv_id")
    ranged = last.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    schema = "depth long, z1 long, z2 long, first long, ids string"

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, z1, z2, conv = (batch.column(k).to_numpy() for k in range(4))
            if not len(d):
                continue
            starts = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (z1[1:] != z1[:-1]) | (z2[1:] != z2[:-1])))
            starts = np.unique(np.concatenate([starts, np.arange(0, len(d), CHUNK_IDS)]))
            text = pc.binary_join(pa.ListArray.from_arrays(np.append(starts, len(d)).astype(np.int32),
                                                           batch.column(3).cast(pa.string())), ",")
            yield pa.RecordBatch.from_arrays([*(pa.array(x[starts]) for x in (d, z1, z2, conv)), text],
                                             ["depth", "z1", "z2", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            for *at, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at == node:
                    state.update(b"," + ids.encode())
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
            if done:
                yield rows(done)
                done = []
        if node is not None:
            yield rows([(*node, state.hexdigest())])

    def rows(done):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*key, "ends_sha256"])

    chunks = ranged.mapInArrow(joined, schema)
    return (chunks.repartition(*key).sortWithinPartitions(*key, "first")
            .mapInArrow(hashed, "depth long, z1 long, z2 long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, family: int = 5, most_shared: int = 8, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """The trie of all rebuilt conversations (conv_id, turn, role, text; other columns are ignored).

    A conversation's turns are ordered by turn, null first; of equal turns the one with the smaller id (a hash of role
    and text) comes first, and repeated rows are turns of their own. A null role or text is empty. Rows without conv_id
    belong to no conversation. Conversation c is rebuilt as the first h original turns of conversation c - c % family (all
    if it has fewer, none if it isn't there) and then its own turns after its first h, h = crc32(c) % (most_shared + 1).

    Returns one row per node, a distinct sequence of first turns (role, text) from the empty one on: conv_id (smallest
    member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves (childless nodes of the subtree),
    saved_tokens (of the subtree: (n_convs - 1) times the bytes of the last text, summed), ends_sha256 (of the ids of the
    conversations that end here). An empty table gives no rows. Turns are told apart by 128 bits of SHA-256, sequences by
    128 bits of a hash of turns with their places.
    """
    spark = conversations.sparkSession
    bounded_batches(spark)
    turns = positioned_turns(hashed_turns(conversations))
    pieces = opened_pieces(materialize(rebuilt_pieces(turns, family, most_shared, piece_turns)))
    key = ["depth", "z1", "z2"]

    # First the smallest member of every node, and from that the depth from which each conversation owns its nodes.
    none = F.lit(False)
    first = trie_parts(pieces.select(*pieces.columns, F.lit(2**62).alias("owned_from"), F.lit(0).cast("long").alias("saved_later"),
                                     none.alias("leaf"), none.alias("owns_next")))
    owners = (first.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.min("before").alias("before"),
                                      (F.sum("n") == F.sum("n_ended")).alias("leaf"))
              .groupBy("conv_id").agg(F.min("depth").alias("owned_from"), F.min("before").alias("shared"), F.max("leaf").alias("leaf")))
    owned = pieces.join(owners, "conv_id", "left")
    n_after = F.col("n_before") + F.expr("aggregate(turns, 0L, (a, t) -> a + t.n_bytes)")
    owned_from = F.coalesce("owned_from", F.lit(2**62))
    marked = owned.select(
        *pieces.columns, owned_from.alias("owned_from"),
        F.greatest(F.coalesce("shared", "total") - n_after, F.lit(0)).alias("saved_later"),
        F.coalesce("leaf", none).alias("leaf"),
        (~F.col("is_last") & (owned_from <= F.col("depth") + F.size("turns") + 1)).alias("owns_next"))

    nodes = materialize(trie_parts(marked).groupBy(*key).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"),
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved")]))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("z1").alias("p1"), F.col("z2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(parents, ["depth", "p1", "p2"], "left").join(end_digests(pieces), key, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
