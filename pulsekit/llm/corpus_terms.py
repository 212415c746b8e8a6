"""Terms (pre-tokens, words) of a corpus: counted over all documents, valued once each, summed back per document.

A term's value (its number of pieces, its count in training documents) is needed at every document that holds it. Most
occurrences are of few terms, so the work is split by frequency, at every size alike:

* *head*: the most frequent terms, at most ``HEAD_TERMS`` of at most ``HEAD_TERM_BYTES`` each, hence a proven size.
  They are broadcast and summed where the text is.
* *tail*: all others. They go as (row, term, frequency) to a join by term, which no hot key can skew, since hot terms
  are in the head.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import LOOKUP_BLOCK_BYTES, blocks, coded, texts_of

HEAD_TERMS = 1 << 17
HEAD_TERM_BYTES = 64
#: Distinct terms that a task gathers before it sends their counts on.
TASK_TERMS = 1 << 19

Splitter = Callable[[pa.Array], tuple[pa.Array, np.ndarray]]


def term_counts(docs: DataFrame, split: Splitter) -> DataFrame:
    """(term, n): occurrences of each term in the column ``text``, pre-aggregated per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            terms, counts = list(held.keys()), list(held.values())
            for at in range(0, len(terms), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(terms[at:at + (1 << 16)], pa.string()),
                                                  pa.array(counts[at:at + (1 << 16)], pa.int64())], names=["term", "n"])

        for part in blocks(batches, "text", LOOKUP_BLOCK_BYTES):
            distinct, codes = coded(split(texts_of(part))[0])
            for term, n in zip(distinct.to_pylist(), np.bincount(codes, minlength=len(distinct)).tolist(), strict=True):
                held[term] = held.get(term, 0) + n
            if len(held) > TASK_TERMS:
                yield from out()
                held = {}
        yield from out()

    return docs.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def head_floor(terms: DataFrame, size: int = HEAD_TERMS) -> float:
    """The smallest count of a head term, so that at most ``size`` terms have it: from a histogram of count classes.

    A class spans an eighth of a power of two, so that the histogram has some hundred rows whatever the corpus.
    """
    rows = (terms.where(F.octet_length("term") <= HEAD_TERM_BYTES).groupBy(F.floor(F.log2("n") * 8).alias("k"))
            .agg(F.count("*").alias("n"), F.min("n").alias("least")).orderBy(F.desc("k")).collect())
    floor, total = float("inf"), 0
    for row in rows:
        total += row["n"]
        if total > size:
            break
        floor = float(row["least"])
    return floor


def most_frequent(terms: DataFrame, size: int) -> dict[str, int]:
    """The ``size`` most frequent terms that may be in a head, with their counts: by count, then by term."""
    rows = terms.where(F.octet_length("term") <= HEAD_TERM_BYTES).orderBy(F.desc("n"), "term").limit(size).collect()
    return {r["term"]: r["n"] for r in rows}


def is_head(floor: float):
    return (F.octet_length("term") <= HEAD_TERM_BYTES) & (F.col("n") >= F.lit(floor))


def document_terms(part: pa.RecordBatch, split: Splitter):
    """Of a block: distinct terms, and per distinct (document, term) pair its document, term code and frequency."""
    flat, offsets = split(texts_of(part))
    distinct, codes = coded(flat)
    docs = np.repeat(np.arange(part.num_rows), np.diff(offsets))
    return distinct, codes, docs, np.diff(offsets)


def pairs(docs: np.ndarray, codes: np.ndarray, n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, code) pairs with their frequencies."""
    keys, counts = np.unique(docs * max(n_codes, 1) + codes, return_counts=True)
    return keys // max(n_codes, 1), keys % max(n_codes, 1), counts
