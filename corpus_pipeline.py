"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Quality rules drop junk, near-dedup keeps one document of each group, decontamination drops documents with benchmark
passages, personal data is replaced in the texts that are left, and these are packed into training sequences. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import bounded_batches, materialize, table
from pulsekit.llm.decontaminate import drop_contaminated
from pulsekit.llm.near_dup import drop_near_duplicates
from pulsekit.llm.packing import pack_documents
from pulsekit.llm.pii import redact_pii
from pulsekit.llm.quality import keep_quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go.

    Every row is judged by itself, repeated rows and rows without doc_id too; null and empty texts have too few words and
    go. All columns stay, whatever their names; an empty table gives an empty table.
    """
    bounded_batches(spark)
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest doc_id: shingles of five words, similarity
    0.8 or more.

    Rows that repeat a doc_id are one document, of which one row stays; rows without doc_id or without words all stay.
    All columns stay, whatever their names; an empty table gives an empty table.
    """
    return drop_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold benchmark passages in a twentieth of their words or more.

    Every row is judged by itself; null and empty texts stay. All columns stay, whatever their names; an empty table
    gives an empty table.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text.

    Every row stays, null and empty texts as they are. All columns stay, whatever their names; an empty table gives an
    empty table.
    """
    return redact_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document, with its ids.

    Repeated rows are packed each, a null doc_id stays null, a null or empty text is its end token alone. Other columns
    than doc_id and text are ignored; an empty table gives no rows.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048,
                          ranks=(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL can express neither the tokenizer's ids nor the packing; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the ``documents`` table; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
