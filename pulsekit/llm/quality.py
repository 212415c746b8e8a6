"""Quality rules as a short-circuit cascade that is ordered by measured rejection per cost.

Each rule reads a few measures of a text. On a bounded sample every rule is run alone: its cost is the time that its
measures take, its selectivity the share that it rejects. The cascade runs the rules by rejection per cost, and a
document that a rule rejects is not looked at by later ones. The order changes the time only: a document is kept if no
rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulsekit.llm.common import blocks, coded, fresh, texts_of, words_of
from pulsekit.llm.shingles import mix

#: Documents that cost and selectivity are estimated on, at most in expectation. It affects the order alone.
SAMPLE_DOCS = 4000

_SALTS = np.random.default_rng(7).integers(0, 2**63, size=4, dtype=np.uint64) * 2 + 1


class Measures:
    """Measures of a block of texts, each computed when a rule first asks for it."""

    def __init__(self, texts: pa.Array):
        self.texts = texts

    @cached_property
    def _words(self) -> tuple[pa.Array, np.ndarray]:
        return words_of(self.texts, lower=False)

    @cached_property
    def _codes(self) -> tuple[pa.Array, np.ndarray]:
        return coded(self._words[0])

    @cached_property
    def _doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.n_words)

    def _per_doc(self, amounts: np.ndarray) -> np.ndarray:
        return np.bincount(self._doc_of_word, weights=amounts, minlength=len(self.texts)).astype(np.int64)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self._words[1])

    @cached_property
    def word_chars(self) -> np.ndarray:
        """Code points in words."""
        return self._per_doc(pc.utf8_length(self._words[0]).to_numpy(zero_copy_only=False))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        """Characters of ``#*$%&|<>`` in the whole text."""
        return pc.count_substring_regex(self.texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64)

    @cached_property
    def n_shouts(self) -> np.ndarray:
        """Exclamation marks in the whole text."""
        return pc.count_substring(self.texts, "!").to_numpy(zero_copy_only=False).astype(np.int64)

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word per document, and how many of these equal an earlier one."""
        lines = pc.split_pattern(self.texts, "\n")
        flat, counts = lines.flatten(), np.diff(lines.offsets.to_numpy())
        full = pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(self.texts)), counts)[full]
        distinct, codes = coded(flat.filter(pa.array(full)))
        pairs = np.unique(doc * max(len(distinct), 1) + codes)
        n = np.bincount(doc, minlength=len(self.texts))
        return n, n - np.bincount(pairs // max(len(distinct), 1), minlength=len(self.texts))

    @cached_property
    def n_lines(self) -> np.ndarray:
        return self._lines[0]

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words in three-word windows that the text has twice or more."""
        codes, doc = self._codes[1].astype(np.uint64), self._doc_of_word
        n = len(codes) - 2
        if n < 1:
            return np.zeros(len(self.texts), np.int64)
        inside = doc[:n] == doc[2:]
        keys = mix(mix(mix(codes[:n] * _SALTS[0] + doc[:n].astype(np.uint64) * _SALTS[3]) ^ (codes[1:n + 1] * _SALTS[1]))
                   ^ (codes[2:] * _SALTS[2]))[inside]
        order = np.argsort(keys)
        ordered = keys[order]
        same = ordered[1:] == ordered[:-1]
        repeated = np.zeros(len(keys), bool)
        repeated[order] = np.append(same, False) | np.append(False, same)
        starts = np.flatnonzero(inside)[repeated]
        covered = np.zeros(len(codes), bool)
        for k in range(3):
            covered[starts + k] = True
        return self._per_doc(covered)

    @cached_property
    def n_top_word(self) -> np.ndarray:
        """Occurrences of the text's most frequent word."""
        distinct, codes = self._codes
        keys, counts = np.unique(self._doc_of_word * max(len(distinct), 1) + codes, return_counts=True)
        top = np.zeros(len(self.texts), np.int64)
        np.maximum.at(top, keys // max(len(distinct), 1), counts)
        return top

    @cached_property
    def n_upper(self) -> np.ndarray:
        """Letters A-Z in the whole text."""
        return pc.count_substring_regex(self.texts, r"[A-Z]").to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass(frozen=True)
class Rule:
    """Rejects the documents for which ``rejects`` is true. It reads only what it needs from the measures."""

    name: str
    rejects: Callable[[Measures], np.ndarray]


#: The failing conditions that the base of the quality stage fixes.
BASE_RULES = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)

#: The rules of the cascade: heavy in symbols, shouting, capitals, one word or one line over and over, odd word lengths.
RULES = (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("shouts", lambda m: 10 * m.n_shouts > m.n_words),
    Rule("capitals", lambda m: 10 * m.n_upper > 4 * m.word_chars),
    Rule("one_word", lambda m: 10 * m.n_top_word > 4 * m.n_words),
    Rule("same_lines", lambda m: 10 * m.n_dup_lines > 5 * m.n_lines),
    Rule("word_length", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 15 * m.n_words)),
)


def _estimate(rules: tuple[Rule, ...]):
    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, rejected, seen = np.zeros(len(rules)), np.zeros(len(rules), np.int64), 0
        for part in blocks(batches, "text"):
            texts = texts_of(part)
            seen += len(texts)
            for k, rule in enumerate(rules):
                began = time.perf_counter()
                rejected[k] += int(rule.rejects(Measures(texts)).sum())
                cost[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array([r.name for r in rules]), pa.array(cost), pa.array(rejected),
                                          pa.array([seen] * len(rules))], names=["rule", "cost", "rejected", "seen"])

    return estimate


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per rule in the order to run: rule, cost (seconds a document), selectivity, gain (rejections a second)."""
    fraction = min(1.0, sample_docs / max(1, docs.count()))
    measured = (docs.select(F.col("text").cast("string").alias("text")).sample(fraction, seed=11)
                .mapInArrow(_estimate(rules), "rule string, cost double, rejected long, seen long"))
    seen = F.greatest(F.sum("seen"), F.lit(1))
    return (measured.groupBy("rule").agg((F.sum("cost") / seen).alias("cost"), (F.sum("rejected") / seen).alias("selectivity"))
            .withColumn("gain", F.col("selectivity") / F.greatest("cost", F.lit(1e-12))).orderBy(F.desc("gain"), "rule"))


def run_cascade(texts: pa.Array, rules: tuple[Rule, ...], measures: Measures | None = None) -> list[str | None]:
    """The first rule that rejects each text, None where none does. Later rules see only what earlier ones left."""
    verdict: list[str | None] = [None] * len(texts)
    alive = np.arange(len(texts))
    measures = measures or Measures(texts)
    for rule in rules:
        if not len(alive):
            break
        out = rule.rejects(measures)
        for k in alive[out].tolist():
            verdict[k] = rule.name
        if out.any():
            alive = alive[~out]
            if 2 * len(alive) < len(measures.texts):  # fewer texts from here; else the measures at hand are cheaper
                measures = Measures(texts.take(pa.array(alive)))
            else:
                measures = _Left(measures, ~out)
    return verdict


class _Left:
    """The rows of ``mask`` of measures: what is computed already is kept."""

    def __init__(self, measures, mask: np.ndarray):
        self._of, self._mask = measures, mask
        self.texts = measures.texts.filter(pa.array(mask))

    def __getattr__(self, name: str) -> np.ndarray:
        return getattr(self._of, name)[self._mask]


def _measured(rules: tuple[Rule, ...], with_base: bool, verdict: str = "rejected_by"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text"):
            texts = texts_of(part)
            if with_base:
                m = Measures(texts)
                failed = np.logical_or.reduce([r.rejects(m) for r in BASE_RULES])
                rule = np.full(len(texts), None, object)
                left = np.flatnonzero(~failed)
                rule[left] = run_cascade(texts.take(pa.array(left)), rules, _Left(m, ~failed))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (
                        m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words)),
                     pa.array(failed), pa.array(rule.tolist(), pa.string())],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                           "rejected_by"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(run_cascade(texts, rules), pa.string())],
                    names=[*part.schema.names, verdict])

    return run


def _ordered(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[Rule, ...]:
    by_name = {r.name: r for r in rules}
    return tuple(by_name[row["rule"]] for row in cascade_order(docs, rules).collect())


def quality_measures(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Base measures and the cascade's verdict, one row per input row of docs (doc_id, text; others are ignored).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rejected_by (the first rule of the
    cascade that rejects it, null if none does or the base failed). A null text is empty: it has no words and fails the
    base. Repeated rows are judged each; a null doc_id stays null.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_measured(_ordered(docs, rules), True),
                             "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                             "n_repeat_words long, base_failed boolean, rejected_by string")


def keep_quality(docs: DataFrame, rules: tuple[Rule, ...] = (*BASE_RULES, *RULES)) -> DataFrame:
    """The rows of docs that no rule rejects, all columns unchanged; every rule is part of the cascade here."""
    verdict = fresh(docs, "rejected_by")
    schema = StructType([*docs.schema.fields, StructField(verdict, StringType())])
    return docs.mapInArrow(_measured(_ordered(docs, rules), False, verdict), schema).where(F.col(verdict).isNull()).drop(verdict)
