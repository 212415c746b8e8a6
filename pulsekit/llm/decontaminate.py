"""Benchmark decontamination with an Aho-Corasick automaton over normalised benchmark windows.

Benchmark words are numbered; its windows of 13 words become keys of an automaton over these numbers (13 nodes a window
at most). A document is normalised in the same way and scanned once; matches are word places, which are mapped back to
offsets in the original text. The text is read once whatever the benchmark's size. A benchmark whose automaton would
outgrow a Python worker is one automaton after the other over each held block of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from pulsekit.llm.common import blocks, bounded_batches, kept

WINDOW = 13
#: Bytes of benchmark text in one automaton: about 90 thousand words, at most 13 nodes each, some 60 bytes a node.
AUTOMATON_BYTES = 512 << 10
#: Bytes of documents that are held when one automaton follows another.
HELD_BYTES = 64 << 20

# Words are runs of 0-9, A-Z, a-z and non-ASCII characters; A-Z count as a-z. On UTF-8 bytes that is a table.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")  # of a text as it was


def normal_words(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8."""
    return (text or "").encode().translate(_TABLE).split()


def build_automaton(items: list[tuple[str, str]]) -> tuple[dict[bytes, int], object]:
    """Numbers of the words of (item id, text), from 1, and the automaton of the windows over them.

    A key's value is its number of words and the ids of its items. No windows: no automaton.
    """
    numbers: dict[bytes, int] = {}
    keys: dict[tuple, set[str]] = {}
    for item_id, text in items:
        words = tuple(numbers.setdefault(w, len(numbers) + 1) for w in normal_words(text))
        for k in range(max(len(words) - WINDOW, 0) + 1 if words else 0):
            keys.setdefault(words[k:k + WINDOW], set()).add(item_id)
    if not keys:
        return numbers, None
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, ids in keys.items():
        automaton.add_word(key, (len(key), tuple(sorted(ids))))
    automaton.make_automaton()
    return numbers, automaton


def find_hits(numbers: dict[bytes, int], automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit word ranges (first, end) in order of their ends, and the items whose windows occur."""
    if automaton is None or not words:
        return [], set()
    ranges, items = [], set()
    for last, (n, ids) in automaton.iter(tuple(map(numbers.get, words, repeat(0)))):
        ranges.append((last + 1 - n, last + 1))
        items.update(ids)
    return ranges, items


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that meet as one."""
    out: list[list[int]] = []
    for first, stop in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([first, stop])
    return [tuple(r) for r in out]


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets (start, end) of word ranges in the text as it was."""
    if not ranges:
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    return [(words[first][0], words[stop - 1][1]) for first, stop in ranges]


_FOUND = StructType([StructField(n, t) for n, t in (
    ("n_words", LongType()), ("n_hit", LongType()), ("items", ArrayType(StringType())),
    ("span_start", ArrayType(IntegerType())), ("span_end", ArrayType(IntegerType())))])


class _Benchmark:
    """The benchmark's parts, broadcast; the id tells the automata apart that a worker keeps."""

    def __init__(self, spark, parts: list[list[tuple[str, str]]]):
        self.parts = spark.sparkContext.broadcast(parts)
        self.id = f"{spark.sparkContext.applicationId}-{self.parts._jbroadcast.id()}"

    def __getstate__(self):
        return {"parts": self.parts, "id": self.id}

    def automata(self) -> Iterator[tuple]:
        """One after the other; the only one stays with the worker."""
        parts = self.parts.value
        if len(parts) > 1:
            yield from map(build_automaton, parts)
            return
        yield kept(f"automaton {self.id}", "", lambda: build_automaton(parts[0]))


def _scan(benchmark: _Benchmark, text: str, names: list[str], only_clean: bool):
    """Appends the findings to the rows, or keeps the rows that aren't contaminated (without findings)."""

    def judged(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: list[list] = [[] for b in held for _ in range(b.num_rows)]
        items: list[set] = [set() for _ in ranges]
        sizes = [0] * len(ranges)
        for numbers, automaton in benchmark.automata():
            k = 0
            for batch in held:
                for value in batch.column(text):
                    words = normal_words(value.as_py())
                    sizes[k] = len(words)
                    hit, ids = find_hits(numbers, automaton, words)
                    if hit:
                        ranges[k] = united(ranges[k] + hit)
                        items[k] |= ids
                    k += 1
        k = 0
        for batch in held:
            rows = []
            for value in batch.column(text):
                spans = original_spans(value.as_py(), ranges[k]) if ranges[k] else []
                rows.append((sizes[k], sum(b - a for a, b in ranges[k]), sorted(items[k]),
                             [a for a, _ in spans], [b for _, b in spans]))
                k += 1
            n_words, n_hit = (np.array([r[c] for r in rows], np.int64) for c in (0, 1))
            if only_clean:
                yield batch.filter(pa.array(~((n_hit > 0) & (20 * n_hit >= n_words))))
                continue
            ints = pa.list_(pa.int32())
            columns = [pa.array(n_words), pa.array(n_hit), pa.array([r[2] for r in rows], pa.list_(pa.string())),
                       pa.array([r[3] for r in rows], ints), pa.array([r[4] for r in rows], ints)]
            yield pa.RecordBatch.from_arrays([*(c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != text), *columns],
                                             [*(n for n in batch.schema.names if n != text), *names])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several = len(benchmark.parts.value) > 1
        held, size = [], 0
        for part in blocks(batches, text):
            held.append(part)
            size += part.nbytes
            if not several or size > HELD_BYTES:
                yield from judged(held)
                held, size = [], 0
        if held:
            yield from judged(held)

    return scan


def _benchmark(benchmark: DataFrame, max_bytes: int) -> _Benchmark:
    """The benchmark in parts of at most ``max_bytes`` of text; a longer item goes over several parts.

    The pieces of such an item overlap by a window less one word, so that every window is in one of them.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    parts: list[list[tuple[str, str]]] = [[]]
    size = 0
    for row in rows.where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        words, at = normal_words(row["text"]), 0
        while words:
            room, taken = max_bytes - size, 0
            lengths = np.cumsum([len(w) + 1 for w in words[at:]])
            taken = int(np.searchsorted(lengths, room, side="right"))
            if taken < len(lengths) and (size or taken < WINDOW):
                if size:  # a new part first
                    parts.append([])
                    size = 0
                    continue
                taken = min(WINDOW, len(lengths))
            parts[-1].append((row["item_id"], b" ".join(words[at:at + taken]).decode()))
            size += int(lengths[taken - 1])
            if at + taken == len(words):
                break
            at += taken - WINDOW + 1
    return _Benchmark(benchmark.sparkSession, parts)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, max_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Words of every document that lie in an occurrence of a benchmark window.

    docs needs doc_id and text, benchmark item_id and text; other columns are ignored. Returns one row per input row:
    doc_id, n_words, n_hit, n_items, items (sorted ids of items with occurring windows), span_start and span_end (code
    points of the hit passages in the original text), contaminated (n_hit > 0 and 20 n_hit >= n_words). A null or
    empty text has no words; repeated rows are judged each; a null doc_id stays null; null items or item texts count
    for nothing, and an empty benchmark hits nothing.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = StructType([source.schema["doc_id"], *_FOUND.fields])
    found = source.mapInArrow(_scan(_benchmark(benchmark, max_bytes), "text", _FOUND.names, False), schema)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "span_start", "span_end",
                        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """docs without the contaminated rows; all columns unchanged, in one pass in which rows meet their own verdict.

    Null and empty texts stay; an empty table gives an empty table and an empty benchmark drops nothing.
    """
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(_scan(_benchmark(benchmark, max_bytes), "text", [], True), docs.schema)
