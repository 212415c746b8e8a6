"""Best-two-fit packing of tokenised documents into fixed-length training sequences.

One plan holds for all documents, however the table is split or ordered:

1. Every task tokenises and cuts the documents of its partition and writes the pieces as a table, each with its number
   among the partition's pieces of its length.
2. Packing works on the counts of piece lengths over all partitions (at most ``capacity`` different ones): a sequence
   takes the longest piece, is filled greedily with the longest that fits, and then its smallest piece is exchanged for
   two unpacked ones while these fill the widened gap more tightly. The same choice is repeated as often as the stock
   allows, so that the plan is a list of patterns of lengths, whose number depends on ``capacity`` and not on the input.
3. A piece's number among all of its length tells its sequence and offset in the plan.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import blocks, materialize, release_memory, texts_of
from pulsekit.llm.tokens import ChunkEncoder

#: Ids that a task holds before it writes their pieces (4 bytes each), and pieces in a batch of the result.
WINDOW_IDS = 4 << 20
EMIT_ROWS = 1024
#: Text bytes that are encoded at a time.
ENCODE_BYTES = 2 << 20

_CUT = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"
_PIECES = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"

#: Piece lengths of a sequence in placing order, and how many such sequences there are.
Pattern = tuple[list[int], int]


def patterns(count: np.ndarray, capacity: int) -> Iterator[Pattern]:
    """Packs ``count[n]`` pieces of each length n (1 to ``capacity``) into bins; equal bins that follow are one pattern."""
    count = count.copy()
    size = np.arange(capacity + 1)
    fits = np.maximum.accumulate(np.where(count > 0, size, 0))  # the longest piece in stock that is not longer

    def move(n: int, by: int) -> None:
        had = count[n] > 0
        count[n] += by
        if (count[n] > 0) != had:  # it appeared or was used up
            fits[n:] = np.maximum.accumulate(np.concatenate([[n if by > 0 else fits[n - 1]],
                                                             np.where(count[n + 1:] > 0, size[n + 1:], 0)]))

    while (longest := int(fits[capacity])) > 0:
        held, gap = [longest], capacity - longest
        move(longest, -1)
        while gap and (n := int(fits[gap])):
            held.append(n)
            move(n, -1)
            gap -= n
        while gap and len(held) > 1:
            smallest = min(held)
            room = gap + smallest
            a = np.flatnonzero(count[:room] > 0)
            if not len(a):
                break
            b = fits[np.minimum(room - a, a)]
            alone = (b == a) & (count[a] < 2)
            b = np.where(alone, fits[np.minimum(room - a, a - 1)], b)
            total = np.where(b > 0, a + b, 0)
            best = int(total.argmax())
            if total[best] <= smallest:
                break
            held.remove(smallest)
            move(smallest, 1)
            for n in (int(a[best]), int(b[best])):
                held.append(n)
                move(n, -1)
            gap = room - int(total[best])
        uses = Counter(held)
        more = min(int(count[n]) // k for n, k in uses.items())
        if more:
            for n, k in uses.items():
                move(n, -k * more)
        yield held, 1 + more


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Packs pieces (1 to ``capacity`` long) into bins; returns the piece numbers of each bin, in placing order."""
    stock: dict[int, list[int]] = defaultdict(list)
    for k, n in enumerate(lengths.tolist()):
        stock[n].append(k)
    count = np.bincount(lengths, minlength=capacity + 1) if len(lengths) else np.zeros(capacity + 1, np.int64)
    return [[stock[n].pop() for n in held] for held, times in patterns(count, capacity) for _ in range(times)]


class Plan:
    """Where the pieces of each length go: runs of slots per length, one run for each pattern with that length."""

    def __init__(self, found: Iterator[Pattern]):
        runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        used: Counter[int] = Counter()
        first = 0
        for held, times in found:
            offset = 0
            for n, k in sorted(Counter(held).items(), reverse=True):
                runs[n].append((used[n], k, first, offset))
                used[n] += k * times
                offset += n * k
            first += times
        self.n_sequences = first
        self.runs = {n: np.array(r, np.int64).T for n, r in runs.items()}

    def slots(self, lengths: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the nth pieces of the lengths."""
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            starts, each, first, offsets = self.runs[n]
            run = np.searchsorted(starts, nth[at], side="right") - 1
            bins, copy = np.divmod(nth[at] - starts[run], each[run])
            sequence[at], offset[at] = first[run] + bins, offsets[run] + copy * n
        return sequence, offset


def _cut(path: str, ranks: tuple[str, str] | None, capacity: int, end_id: int, window_ids: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path, ranks)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)  # pieces of each length so far
        out: list[tuple] = []
        held = 0

        def emit() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              names=["doc_id", "piece", "start", "length", "ids", "part", "nth"])

        for block in blocks(batches, "text", ENCODE_BYTES):
            for doc_id, ids in zip(block.column("doc_id").to_pylist(), encoder.encode(texts_of(block)), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                n_pieces = -(-len(ids) // capacity)
                start = 0
                for piece in range(n_pieces):
                    stop = len(ids) - (n_pieces - 1 - piece) * capacity
                    out.append((doc_id, piece, start, stop - start, ids[start:stop].tobytes(), part, seen[stop - start]))
                    seen[stop - start] += 1
                    held += stop - start
                    start = stop
                    if len(out) == EMIT_ROWS or held > window_ids:
                        yield emit()
                        out, held = [], 0
        if out:
            yield emit()

    return cut


def _place(plan: Plan):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            if not batch.num_rows:
                continue
            nth = batch.column("nth").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = plan.slots(batch.column("length").to_numpy(), nth)
            names = ["doc_id", "piece", "start", "length", "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    return place


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                   window_ids: int = WINDOW_IDS, ranks: tuple[str, str] | None = None) -> DataFrame:
    """Packs documents (doc_id, text; other columns are ignored) into sequences of at most ``capacity`` tokens.

    A document is its ids and then ``end_id``. Only a document that is longer than ``capacity`` is cut: into whole
    pieces of that length, of which the first may be shorter. Returns one row per piece: doc_id, piece, start (ids of
    the document before it), length, ids (binary, unsigned 32-bit little-endian), sequence_id, offset in the sequence.
    ``ranks`` (path, pattern) optionally names the same vocabulary as ranks, which is faster.
    A null or empty text is the end token alone; repeated rows are packed each; a null doc_id stays null.
    The number of sequences depends on the documents only, not on the table's partitions or their order.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = materialize(source.mapInArrow(_cut(tokenizer_path, ranks, capacity, end_id, window_ids), _CUT))
    # A partition's pieces of a length are numbered after those of the partitions before it.
    counts = materialize(cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    count = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most capacity rows
        count[row.length] = row.n
    plan = Plan(patterns(count, capacity))
    return cut.join(before, ["part", "length"]).mapInArrow(_place(plan), _PIECES)
