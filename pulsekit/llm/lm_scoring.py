"""Language-model scores of documents: a gated recurrent model over a small vocabulary, and exact corpus counts below it.

The recurrent model predicts, word by word over the whole document, one of the most frequent words, the end, or one of
``WORD_TYPES`` spelling types (by a word's last two characters) for all other words. Within a type a word has its
add-one share of the training tokens of the type, with one share for unseen words. So every word of the corpus has a
probability, and counts are taken over all training documents (see corpus_terms for the plan).

Training: a warm start on a bounded sample in the driver breaks the symmetry; then every task takes a pass over the
training documents of its own partition from there, and the results are averaged by tokens in a tree of bounded groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import LOOKUP_BLOCK_BYTES, blocks, coded, materialize, words_of
from pulsekit.llm.corpus_terms import HEAD_TERMS, document_terms, head_floor, is_head, most_frequent, pairs, term_counts
from pulsekit.llm.gru import Adam, Gru, score, train

VOCABULARY = 960
WORD_TYPES = 63
HIDDEN = 16
#: Documents of the warm start; only whole documents of at most so many code points are taken.
WARM_DOCS, WARM_CHARS = 400, 4000
#: Training tokens of a task, and how many tasks there are at most.
TASK_TOKENS, MOST_TASKS = 4 << 20, 20000
#: Tokens that a task holds at a time, and how many results one task averages.
HELD_TOKENS = 4 << 20
FAN_IN = 32


def lowered_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return words_of(texts, lower=True)


def word_types(distinct: pa.Array) -> np.ndarray:
    """Spelling type of each word, by its last two characters: computed once for each ending."""
    endings, codes = coded(pc.utf8_slice_codeunits(distinct, -2))
    types = np.fromiter((zlib.crc32(e.encode()) % WORD_TYPES for e in endings.to_pylist()), np.int64, len(endings))
    return types[codes]


class Lookup:
    """Words with a number each, looked up for whole arrays."""

    def __init__(self, words: list[str], values):
        self.words, self.values = pa.array(words, pa.large_string()), np.append(np.asarray(values, np.int64), -1)

    def __call__(self, distinct: pa.Array) -> np.ndarray:
        """The number of each word, -1 if there is none."""
        at = pc.fill_null(pc.index_in(distinct.cast(pa.large_string()), value_set=self.words), -1)
        return self.values[at.to_numpy(zero_copy_only=False)]


class Vocabulary:
    """Token numbers by frequency: the model's words, types of other words, and the end."""

    def __init__(self, words: dict[str, int], type_counts: np.ndarray, n_docs: int):
        counts = np.array([*words.values(), *type_counts.tolist(), n_docs], np.float64)
        order = np.argsort(-counts, kind="stable")
        self.counts = counts[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.known = Lookup(list(words), rank[:len(words)])
        self.types = rank[len(words):len(words) + WORD_TYPES]
        self.end = int(rank[-1])

    def numbers(self, distinct: pa.Array) -> np.ndarray:
        known = self.known(distinct)
        return np.where(known >= 0, known, self.types[word_types(distinct)])


def _documents(numbers: np.ndarray, codes: np.ndarray, lengths: np.ndarray, end: int) -> list[np.ndarray]:
    ends = np.cumsum(lengths)
    flat = np.insert(numbers[codes].astype(np.int32), ends, end)
    return np.split(flat, (ends + np.arange(1, len(ends) + 1))[:-1])


def _typed(known: Lookup):
    def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shares = np.zeros(WORD_TYPES, np.int64), np.zeros(WORD_TYPES, np.int64)
        for batch in batches:
            terms = batch.column("term")
            other = known(terms) < 0
            types, n = word_types(terms)[other], batch.column("n").to_numpy()[other]
            np.add.at(tokens, types, n)
            np.add.at(shares, types, n + 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(WORD_TYPES), pa.int32()), pa.array(tokens), pa.array(shares)],
                                         names=["type", "tokens", "shares"])

    return typed


def _trained(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = shared.value
        model = Gru(vocabulary.counts, HIDDEN).load(start)
        optimizer, seen, held, size = Adam(model, 0.005), 0, [], 0
        for part in blocks(batches, "text", LOOKUP_BLOCK_BYTES):
            distinct, codes, _, lengths = document_terms(part, lowered_words)
            held += _documents(vocabulary.numbers(distinct), codes, lengths, vocabulary.end)
            size += int(lengths.sum()) + len(lengths)
            if size > HELD_TOKENS:
                seen += train(model, held, vocabulary.end, 256, 32, optimizer)
                held, size = [], 0
        seen += train(model, held, vocabulary.end, 256, 32, optimizer)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([seen], pa.int64()),
                 pa.array([model.flat().astype("<f4").tobytes()], pa.binary())], names=["part", "seen", "weights"])

    return run


def _averaged(key, rows):
    """Mean of a group's weights by tokens; a group has FAN_IN rows at most."""
    found = sorted(rows.to_pylist(), key=lambda r: r["part"])
    seen = sum(r["seen"] for r in found)
    mean = sum(np.frombuffer(r["weights"], "<f4").astype(np.float64) * (r["seen"] / seen) for r in found)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "seen": pa.array([seen], pa.int64()),
                     "weights": pa.array([mean.astype("<f4").tobytes()], pa.binary())})


def train_model(training: DataFrame, vocabulary: Vocabulary, n_tokens: int) -> np.ndarray:
    """Weights after the warm start and one pass of all tasks over the training documents (doc_id, text).

    The documents are dealt to tasks by their own hash and sorted there, and the number of tasks follows from the number
    of tokens, so that the model doesn't depend on how the table is split.
    """
    spark = training.sparkSession
    model = Gru(vocabulary.counts, HIDDEN)
    sample = (training.where(F.length("text") <= WARM_CHARS).select("text").orderBy(F.xxhash64("text"), "text")
              .limit(WARM_DOCS).toArrow())
    texts = pa.concat_arrays([pa.array([], pa.large_string()), *(c.cast(pa.large_string()) for c in sample.column("text").chunks)])
    flat, offsets = lowered_words(texts)
    distinct, codes = coded(flat)
    docs = _documents(vocabulary.numbers(distinct), codes, np.diff(offsets), vocabulary.end) if len(texts) else []
    optimizer = Adam(model, 0.01)
    for _ in range(2):
        train(model, docs, vocabulary.end, 32, 32, optimizer)
    tasks = min(-(-n_tokens // TASK_TOKENS), MOST_TASKS)
    if not tasks:
        return model.flat()
    key = F.xxhash64("doc_id", "text")
    dealt = training.repartition(tasks, key).sortWithinPartitions(key)
    shared = spark.sparkContext.broadcast((vocabulary, model.flat()))
    schema = "part long, seen long, weights binary"
    results = materialize(dealt.select("text").mapInArrow(_trained(shared), schema))
    top = results.agg(F.max("part")).first()[0]
    while top is not None and top >= FAN_IN:
        results = materialize(results.withColumn("part", F.floor(F.col("part") / FAN_IN))
                              .groupBy("part").applyInArrow(_averaged, schema))
        top //= FAN_IN
    rows = results.orderBy("part").collect()
    seen = sum(r["seen"] for r in rows)
    return sum(np.frombuffer(r["weights"], "<f4").astype(np.float64) * (r["seen"] / seen) for r in rows).astype(np.float32)


def _scored(shared, head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, shares = shared.value
        model = Gru(vocabulary.counts, HIDDEN).load(weights)
        counts = head.value
        log_shares = np.log10(shares)
        held: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            """One row per held document with its scores, under a key that is no word and spread over the tasks."""
            logs = score(model, [h[-1] for h in held], vocabulary.end) / np.log(10)
            rows = list(zip(*(h[:-1] for h in held), strict=True))
            for at in range(0, len(held), 1 << 14):
                part = slice(at, at + (1 << 14))
                rid = rows[0][part]
                yield pa.RecordBatch.from_arrays([
                    pa.array(rid, pa.int64()), pa.array([f" {r}" for r in rid]), pa.array([1] * len(rid), pa.int64()),
                    pa.array(rows[1][part], pa.int64()), pa.array(rows[2][part], pa.int64()), pa.array(rows[3][part], pa.int64()),
                    pa.array(rows[4][part]), pa.array(np.array(rows[5][part]) + logs[part]),
                ], names=["rid", "term", "freq", "doc_id", "n_tokens", "n_known", "base", "score"])

        for part in blocks(batches, "text", LOOKUP_BLOCK_BYTES):
            distinct, codes, docs, lengths = document_terms(part, lowered_words)
            n = part.num_rows
            c = counts(distinct)
            numbers = vocabulary.numbers(distinct)
            other = vocabulary.known(distinct) < 0
            share = log_shares[word_types(distinct)]
            log_c = np.where(c >= 0, np.log10(np.maximum(c, 0) + 1), 0.0)
            base = np.bincount(docs, weights=log_c[codes], minlength=n)
            below = np.bincount(docs, weights=np.where(other, log_c - share, 0.0)[codes], minlength=n)
            known = np.bincount(docs, weights=(c > 0)[codes], minlength=n)
            tail_doc, tail_code, freq = pairs(docs[c[codes] < 0], codes[c[codes] < 0], len(distinct))
            rid = part.column("rid").to_numpy()
            none = pa.nulls(len(freq), pa.float64())
            yield pa.RecordBatch.from_arrays([
                pa.array(rid[tail_doc]), distinct.take(pa.array(tail_code)).cast(pa.string()), pa.array(freq, pa.int64()),
                none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none, none,
            ], names=["rid", "term", "freq", "doc_id", "n_tokens", "n_known", "base", "score"])
            held += zip(rid.tolist(), part.column("doc_id").to_pylist(), (lengths + 1).tolist(), known.astype(int).tolist(),
                        base.tolist(), below.tolist(), _documents(numbers, codes, lengths, vocabulary.end), strict=True)
            size += int(lengths.sum()) + n
            if size > HELD_TOKENS:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    return run


def score_documents(docs: DataFrame, folds: int = 7, held_fold: int = 2, head_terms: int = HEAD_TERMS) -> DataFrame:
    """Scores every document (doc_id, text; other columns are ignored) under a model of the training documents.

    Training documents are those whose crc32(doc_id as text) mod ``folds`` is not ``held_fold``. Tokens are the words, A-Z
    lower-cased, and one end. Returns one row per input row: doc_id, held_out, n_tokens, n_known (tokens seen in
    training), train_tokens, base_score (add-one unigram) and score (the model's), both log10 of the whole document.
    A null text is empty: its end is its only token. A null doc_id counts as the empty text in the fold. Repeated rows
    are counted and scored each. Without training documents all scores come from an untrained model. The scores depend on
    the rows alone, not on their order or partitions, but for rounding in the sums.
    """
    spark = docs.sparkSession
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds
    source = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                         (fold == held_fold).alias("held_out"))
    training = source.where("NOT held_out")
    terms = materialize(term_counts(training, lowered_words))
    n_docs = training.count()
    sums = terms.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_tokens, v = (sums["n"] or 0) + n_docs, sums["v"] + (n_docs > 0)

    words = most_frequent(terms, VOCABULARY)
    by_type = (terms.mapInArrow(_typed(Lookup(list(words), range(len(words)))), "type int, tokens long, shares long")
               .groupBy("type").agg(F.sum("tokens").alias("tokens"), F.sum("shares").alias("shares")).collect())
    tokens, shares = np.zeros(WORD_TYPES), np.ones(WORD_TYPES)
    for r in by_type:
        tokens[r["type"]], shares[r["type"]] = r["tokens"], r["shares"] + 1
    vocabulary = Vocabulary(words, tokens, n_docs)
    weights = train_model(training, vocabulary, n_tokens)

    floor = head_floor(terms, max(head_terms, VOCABULARY))
    head = {r["term"]: r["n"] for r in terms.where(is_head(floor)).toLocalIterator()}
    missed = [w for w in words if w not in head]  # the head takes whole classes of counts, the model single words
    head |= words
    rows = source.mapInArrow(
        _scored(spark.sparkContext.broadcast((vocabulary, weights, shares)), spark.sparkContext.broadcast(Lookup(list(head), list(head.values())))),
        "rid long, term string, freq long, doc_id long, n_tokens long, n_known long, base double, score double")
    tail = terms.where(~is_head(floor) & ~F.col("term").isin(missed)).select("term", F.col("n").alias("c"))
    is_tail = F.col("n_tokens").isNull()
    weight = F.when(is_tail, F.col("freq") * F.log10(F.coalesce("c", F.lit(0)) + 1))
    # the end is a token of every document; a type's share was taken off where the text is, but for tail words
    share_of = F.when(is_tail, F.lit(0.0)).otherwise(F.col("score"))
    end_count = float(np.log10(n_docs + 1))
    return (rows.join(tail, "term", "left").groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(is_tail, F.when(F.col("c") > 0, F.col("freq")).otherwise(0)).otherwise(F.col("n_known"))).alias("known"),
        F.sum(F.coalesce(weight, "base")).alias("base"), F.sum(F.coalesce(weight, share_of)).alias("score"))
        .select("doc_id", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == held_fold)
                .alias("held_out"), "n_tokens", (F.col("known") + F.lit(int(n_docs > 0))).alias("n_known"),
                F.lit(n_tokens).cast("long").alias("train_tokens"),
                (F.col("base") + F.lit(end_count) - F.col("n_tokens") * F.lit(float(np.log10(n_tokens + v + 1)))).alias("base_score"),
                "score"))
