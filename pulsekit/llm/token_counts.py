"""Token counts per document: pieces are counted once per distinct pre-token, then summed by frequency.

The pre-token is what stands between spaces: the tokenizer drops white space and no token spans a space, so a text has
as many tokens as its pre-tokens together. Token ids are never kept. See corpus_terms for the plan (head and tail).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import LOOKUP_BLOCK_BYTES, blocks, drop_empty, materialize
from pulsekit.llm.corpus_terms import HEAD_TERMS, document_terms, head_floor, is_head, pairs, term_counts
from pulsekit.llm.tokens import piece_counts


def pre_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return drop_empty(pc.split_pattern(texts, " "))


def _counted(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = piece_counts(path, batch.column("term").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("term"), batch.column("n"), pa.array(pieces, pa.int64())],
                                             names=["term", "n", "pieces"])

    return count


def _document_rows(head):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value
        for part in blocks(batches, "text", LOOKUP_BLOCK_BYTES):
            distinct, codes, docs, _ = document_terms(part, pre_tokens)
            values = np.fromiter((known.get(t, -1) for t in distinct.to_pylist()), np.int64, len(distinct))
            of = values[codes]
            sums = np.bincount(docs[of >= 0], weights=of[of >= 0], minlength=part.num_rows).astype(np.int64)
            tail_doc, tail_code, freq = pairs(docs[of < 0], codes[of < 0], len(distinct))
            rid = part.column("rid").to_numpy()
            # one row per document with its head's sum, under a key that is no pre-token and is spread over the tasks
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([part.column("rid"), pa.array(rid[tail_doc])]),
                pa.concat_arrays([pa.array([f" {r}" for r in rid.tolist()], pa.string()),
                                  distinct.take(pa.array(tail_code)).cast(pa.string())]),
                pa.array(np.concatenate([sums, freq]), pa.int64()),
                pa.concat_arrays([part.column("doc_id"), pa.nulls(len(freq), pa.int64())]),
                pa.concat_arrays([part.column("n_bytes"), pa.nulls(len(freq), pa.int64())]),
            ], names=["rid", "term", "amount", "doc_id", "n_bytes"])

    return rows


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, head_terms: int = HEAD_TERMS) -> DataFrame:
    """Tokens of every document (doc_id, text; other columns are ignored) as the tokenizer counts them whole.

    Returns one row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit). A null text is
    empty and has 0 tokens; repeated rows are counted each; a null doc_id stays null.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                         text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    terms = materialize(term_counts(source, pre_tokens).mapInArrow(_counted(tokenizer_path),
                                                                   "term string, n long, pieces long"))
    floor = head_floor(terms, head_terms)
    head = {r["term"]: r["pieces"] for r in terms.where(is_head(floor)).select("term", "pieces").toLocalIterator()}
    rows = source.mapInArrow(_document_rows(docs.sparkSession.sparkContext.broadcast(head)),
                             "rid long, term string, amount long, doc_id long, n_bytes long")
    tail = terms.where(~is_head(floor)).select("term", "pieces")
    return (rows.join(tail, "term", "left").groupBy("rid")
            .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
                 F.sum(F.col("amount") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
