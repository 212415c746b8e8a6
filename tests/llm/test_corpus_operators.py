"""Near-duplicates, decontamination, personal data, scoring, shards, URL rules and the pipeline against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pulsekit.llm import lm_scoring, near_dup
from pulsekit.llm.common import drop_materialized, materialize
from pulsekit.llm.components import connected_components
from pulsekit.llm.decontaminate import benchmark_hits, drop_contaminated
from pulsekit.llm.gru import Adam, Gru, score, train
from pulsekit.llm.lm_scoring import score_documents
from pulsekit.llm.near_dup import drop_near_duplicates, near_duplicates
from pulsekit.llm.pii import _Words, base_spans, candidates, contexts, find_pii, joined_spans, redact_pii
from pulsekit.llm.shingles import joint_estimate, registers
from pulsekit.llm.sharding import shard_documents, write_shards
from pulsekit.llm.url_rules import filter_urls, mine_rules, url_parts

DOCS = "doc_id long, text string, rid string, n_chars int"
LOWER = {k: k + 32 for k in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# Near-duplicates

def shingles(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def brute_components(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if docs[i][0] == docs[j][0] or both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for k, (d, _) in enumerate(docs):
        least[root(k)] = min(least.get(root(k), d), d)
    return [(d, len(s), least[root(k)]) for k, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def near_copies(seed=4):
    """Originals with copies of all distances around the threshold, short and empty texts, exact copies."""
    r = random.Random(seed)
    docs = [(0, ""), (1, None), (2, "a b"), (3, "A  b\n"), (4, "a b c d e"), (5, "x"), (6, "a b c d f")]
    for _ in range(12):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.randint(30, 160))]
        docs.append((len(docs), " ".join(base)))
        for _ in range(r.randint(0, 14)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = f"n{r.randint(0, 9999)}"
            docs.append((len(docs), "\t".join(copy[r.randint(0, 3):])))
    return docs


@pytest.mark.parametrize("block_bytes", [2 << 20, 4000])
def test_near_duplicates(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(near_dup, "BLOCK_SET_BYTES", block_bytes)
    docs = near_copies()
    docs.append(docs[20])  # a repeated row
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs] + [(None, "a b", "x", 1)], DOCS)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame).collect() if r.doc_id is not None)
    assert got == sorted((d, n, c, d == c) for d, n, c in brute_components(docs))
    for percent in (80, 85):
        kept = drop_near_duplicates(frame, percent=percent).collect()
        assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for _, _, c in brute_components(docs, percent)})
    assert sum(r.doc_id is None for r in kept) == 1 and kept[0].asDict().keys() == frame.first().asDict().keys()


def test_materialized_tables_can_be_dropped(spark):
    drop_materialized(spark)
    kept = materialize(spark.range(5))
    assert kept.count() == 5 and drop_materialized(spark) == 1 and drop_materialized(spark) == 0


def test_near_duplicates_of_nothing(spark):
    frame = spark.createDataFrame([], DOCS)
    assert near_duplicates(frame).count() == drop_near_duplicates(frame).count() == 0


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        pool = r.integers(0, 2**63, 4000, dtype=np.uint64)
        both = int(share * 4000)
        a, b = pool[:both + (4000 - both) // 2], np.concatenate([pool[:both], pool[both + (4000 - both) // 2:]])
        ra, rb = registers(a), registers(b)
        assert (np.maximum(ra, rb) == registers(pool)).all()
        got = joint_estimate(ra[None], rb[None], np.array([len(a)], float), np.array([len(b)], float))[0]
        assert abs(got - share) < 0.13


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 199)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)} | {199: 199, 200: 199}
    assert got == want


# Decontamination

def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_hits(text, items):
    w, hit, found = alnum(text), set(), set()
    for item, asked in items:
        a = alnum(asked)
        for window in [a[k:k + 13] for k in range(max(len(a) - 12, 1))] if a else []:
            for k in range(len(w) - len(window) + 1):
                if w[k:k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("max_bytes", [1 << 20, 100])
def test_decontamination(spark, max_bytes):
    r = random.Random(6)
    vocabulary = ["Ab", "c-D", "é", "9", "zz", "\n", "…", "Q.", "\x1c"]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 30)))) for k in range(8)] + [(8, ""), (10, None), (9, "Zz")]
    texts = [None, "", *(" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60))) for _ in range(80))]
    texts += [f"start here {t} and go on" for _, t in items if t] + ["nothing " * 50]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)] + [(3, texts[3], "x", 1), (None, "a", "x", 1)], DOCS)
    benchmark = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")
    rows = benchmark_hits(docs, benchmark, max_bytes).collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        if row.doc_id is None:
            continue
        text = texts[row.doc_id]
        assert (row.n_words, row.n_hit, row["items"], row.contaminated) == brute_hits(text, items), text
        assert sum(len(alnum(text[s:e])) for s, e in zip(row.span_start, row.span_end, strict=True)) == row.n_hit
    clean = drop_contaminated(docs, benchmark, max_bytes)
    assert clean.schema == docs.schema
    assert clean.count() == sum(not x.contaminated for x in rows)
    nothing = benchmark_hits(docs, benchmark.limit(0)).collect()
    assert len(nothing) == len(rows) and not any(x.contaminated for x in nothing)
    assert benchmark_hits(docs.limit(0), benchmark).count() == 0


def test_long_items_over_several_automata(spark):
    r = random.Random(4)
    item = [f"w{r.randint(0, 30)}" for _ in range(400)]
    texts = [" ".join(item[k:k + 13]) for k in range(388)] + [" ".join(item[k:k + 12]) for k in range(0, 380, 7)]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], DOCS)
    rows = benchmark_hits(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), 90).collect()
    assert all((x.n_hit >= 13) == (x.doc_id < 388) for x in rows) and len(rows) == len(texts)


def test_stages_keep_their_rows_when_cores_are_lost(spark, tmp_path):
    """Between building and running a stage the table is split in another way; the rows that stay must not change."""
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(13)
    source.write.parquet(f"{tmp_path}/docs")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    old = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    for stage in (drop_near_duplicates, redact_pii, lambda d: drop_contaminated(d, benchmark)):
        results = []
        for before, after in ((4, 4), (4, 3), (2, 16)):
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)
            result = stage(spark.read.parquet(f"{tmp_path}/docs"))
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", after)
            results.append(sorted((r.doc_id, r.text) for r in result.collect()))
        assert results[0] == results[1] == results[2]
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism") if old is None else spark.conf.set("spark.sql.leafNodeDefaultParallelism", old)


# Personal data

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(n - 9 * (n > 9) for n in doubled) % 10 == 0


def brute_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), k, kind, m.end()))
    return [(s, kind, e) for s, _, kind, e in sorted(out)]


def test_base_spans_fuzz():
    r = random.Random(3)
    for _ in range(20000):
        text = "".join(r.choice("aB@..--+%_ 1204255()  xé") for _ in range(r.randint(0, 40)))
        assert base_spans(text) == brute_base(text), text
    for long in ("a" * 200000, "1" * 200000, "1." * 100000, "a@" * 100000, "+1" + "-" * 200000, "@" * 200000, "(" * 200000):
        base_spans(long)


def test_bootstrapping_finds_unseen_identifiers(spark):
    seeds = [f"please call me at +1 (212) 555-{1000 + k} today" for k in range(8)]
    unseen = ["please call me at 0171-555-8899 today", "no cue 0171-555-8899 here"]
    plain = [f"the order of {5551000 + k} pieces" for k in range(8)] + [None, "", "mail a.b@c.example.com now, 10.0.0.1"]
    texts = [*seeds, *unseen, *plain]
    docs = spark.createDataFrame([(k, t, "x", 7) for k, t in enumerate(texts)] + [(0, seeds[0], "x", 7), (None, "x", "x", 7)], DOCS)
    rows = find_pii(docs).withColumn("spans", joined_spans("added")).collect()
    added = {r.doc_id: r.spans for r in rows if r.spans}
    start = unseen[0].index("0171")
    assert added == {8: f"phone:{start}:{start + 13}"}
    for r in rows:
        if r.doc_id is not None:
            assert [(s.start, s.kind, s.end) for s in r.base] == brute_base(texts[r.doc_id])
    clean = {r.doc_id: r for r in redact_pii(docs).collect()}
    assert redact_pii(docs).schema.names == docs.columns and len(clean) == len(texts) + 1
    assert clean[8].text == "please call me at <PHONE> today" and clean[8].n_chars == len(clean[8].text)
    assert clean[len(texts) - 1].text == "mail <EMAIL> now, <IP>" and clean[9].text == unseen[1] and clean[9].n_chars == 7
    assert find_pii(docs.limit(0)).count() == redact_pii(docs.limit(0)).count() == 0


# Language model

@pytest.mark.parametrize("head", [1, 1 << 17])
def test_scores(spark, head):
    r = random.Random(8)
    tongues = [[f"{p}{k}" for k in range(400)] for p in ("un", "ge", "la")]
    texts = [None, "", *(" ".join(r.choice(t) for _ in range(r.randint(5, 120))) for t in tongues for _ in range(120)), "New words Only"]
    docs = [*enumerate(texts), (5, texts[5]), (None, "un1")]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS)
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    counts = Counter(w for d, t in docs if not held(d) for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    rows = score_documents(frame, head_terms=head).collect()
    assert len(rows) == len(docs)
    for row in rows:
        tokens = [*words("un1" if row.doc_id is None else texts[row.doc_id]), None]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (
            held(row.doc_id), len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert row.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
    out = [x for x in rows if x.held_out and x.n_tokens > 5]
    assert sum(x.score for x in out) > sum(x.base_score for x in out)
    assert score_documents(frame.limit(0)).count() == 0


def test_vocabulary_is_the_most_frequent_words(spark, monkeypatch):
    seen, init = [], lm_scoring.Vocabulary.__init__
    monkeypatch.setattr(lm_scoring.Vocabulary, "__init__", lambda self, words, *rest: seen.append(words) or init(self, words, *rest))
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    equal = " ".join(f"w{k:04}" for k in range(1100))  # more words than the model's share one class of counts
    docs = [(d, t, "x", 1) for d, t in enumerate([equal, equal, "w1099 w1099", "w1099 w0003 rare"]) if not held(d)]
    counts = Counter(w for _, t, _, _ in docs for w in words(t))
    rows = score_documents(spark.createDataFrame(docs, DOCS), head_terms=1).collect()
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:lm_scoring.VOCABULARY]
    assert list(seen[0].items()) == want and len(want) == lm_scoring.VOCABULARY
    n, v = sum(counts.values()) + len(docs), len(counts) + 1
    for row in rows:
        text = words(docs[[d for d, *_ in docs].index(row.doc_id)][1])
        base = sum(np.log10((c + 1) / (n + v + 1)) for c in [*(counts[w] for w in text), len(docs)])
        assert row.n_known == row.n_tokens and row.base_score == pytest.approx(base) and np.isfinite(row.score)


def test_model_is_a_distribution_and_lanes_do_not_matter():
    r = np.random.default_rng(2)
    model = Gru(np.arange(11, 0, -1).astype(float), hidden=4)
    docs = [np.append(r.integers(1, 11, r.integers(0, 40)), 0).astype(np.int32) for _ in range(30)]
    train(model, docs, 0, 4, 8, Adam(model, 0.05))
    total = sum(np.exp(score(model, [np.array([a, b], np.int32)], 0)[0]) for a in range(11) for b in range(11))
    assert total == pytest.approx(1, abs=1e-4)
    alone = [score(model, [d], 0, 1, 1000)[0] for d in docs]
    assert score(model, docs, 0, 7, 5) == pytest.approx(alone, abs=1e-3)


def naive_logs(model, doc, end):
    """Natural log-probability of each token, step by step in float64, with the softmax written out."""
    p, h, before, out = {k: x.astype(np.float64) for k, x in model.p.items()}, np.zeros(model.h), end, []
    for token in doc:
        x, g = p["we"][before] @ p["wi"], h @ p["wh"]
        z, r = (1 / (1 + np.exp(-(x[k * model.h:(k + 1) * model.h] + g[k * model.h:(k + 1) * model.h]))) for k in (0, 1))
        n = np.tanh(x[2 * model.h:] + r * (g[2 * model.h:] + p["bh"]))
        h = z * h + (1 - z) * n
        classes, c = np.exp(h @ p["wc"] + p["bc"]), token // model.size
        words_ = np.exp(h @ p["wo"][c] + p["bo"][c])
        out.append(np.log(classes[c] / classes.sum() * words_[token % model.size] / words_.sum()))
        before = token
    return np.array(out)


def test_model_against_naive_recurrence_and_numerical_gradient():
    r = np.random.default_rng(4)
    model = Gru(np.arange(14, 0, -1).astype(float), hidden=5)
    for k, x in model.p.items():  # away from the start, where much is zero
        model.p[k] = np.where(x > -1e8, x + r.normal(0, 0.3, x.shape), x).astype(np.float32)
    docs = [np.append(r.integers(1, 14, n), 0).astype(np.int32) for n in (0, 1, 7, 90)]
    want = [naive_logs(model, d, 0).sum() for d in docs]
    assert score(model, docs, 0, 3, 4) == pytest.approx(want, rel=1e-4)

    class Kept:
        def step(self, grads, n, share=1.0):
            self.grads = grads

    kept, doc = Kept(), docs[2]
    train(model, [doc], 0, 1, 32, kept)  # one window: nothing is cut off
    for name, x in model.p.items():
        for at in r.permutation(x.size)[:12]:
            place = np.unravel_index(at, x.shape)
            if x[place] < -1e8:
                continue
            sides = []
            for step in (1e-2, -1e-2):
                old = x[place]
                x[place] = old + step
                sides.append(naive_logs(model, doc, 0).sum())
                x[place] = old
            assert kept.grads[name][place] == pytest.approx((sides[0] - sides[1]) / 2e-2, rel=0.02, abs=2e-3), name


def scored_frame(spark, copies=1):
    r = random.Random(12)
    texts = [" ".join(r.choice(["aa", "Ab", "bc", "cd", "é"]) + r.choice("xyz") for _ in range(r.randint(0, 60))) for _ in range(150)]
    texts += ["long " * 20000, None, "", "same text", "same text"]
    return spark.createDataFrame([(d, t, "x", 1) for d, t in enumerate(texts)], DOCS), texts


def test_scores_against_naive_recomputation(spark, monkeypatch):
    frame, texts = scored_frame(spark)
    seen = []

    def random_weights(training, vocabulary, n_tokens):
        model = Gru(vocabulary.counts, lm_scoring.HIDDEN)
        flat = model.flat()
        flat = np.where(flat > -1e8, flat + np.random.default_rng(1).normal(0, 0.1, flat.shape), flat).astype(np.float32)
        seen.append((vocabulary, model.load(flat)))
        return flat

    monkeypatch.setattr(lm_scoring, "train_model", random_weights)
    monkeypatch.setattr(lm_scoring, "VOCABULARY", 6)
    rows = score_documents(frame, head_terms=4).collect()
    (vocabulary, model), = seen
    counts = Counter(w for d, t in enumerate(texts) if zlib.crc32(str(d).encode()) % 7 != 2 for w in words(t))
    top = dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:6])
    kind = lambda w: zlib.crc32(w[-2:].encode()) % lm_scoring.WORD_TYPES
    shares = Counter()
    for w, c in counts.items():
        if w not in top:
            shares[kind(w)] += c + 1
    numbers = dict(zip(top, vocabulary.known.values[:6].tolist(), strict=True))
    for row in rows:
        text = words(texts[row.doc_id])[:400] if row.doc_id == 150 else words(texts[row.doc_id])
        doc = [numbers.get(w, vocabulary.types[kind(w)]) for w in text] + [vocabulary.end]
        below = sum(np.log10((counts[w] + 1) / (shares[kind(w)] + 1)) for w in text if w not in top)
        want = naive_logs(model, doc, vocabulary.end).sum() / np.log(10) + below
        if row.doc_id == 150:
            assert row.n_tokens == 20001 and row.score < want
        else:
            assert row.score == pytest.approx(want, rel=1e-4), row.doc_id


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "TASK_TOKENS", 3000)
    monkeypatch.setattr(lm_scoring, "FAN_IN", 2)  # the averages of eight tasks in three levels
    frame, _ = scored_frame(spark)
    one, many = ({r.doc_id: r.score for r in score_documents(frame.repartition(n)).collect()} for n in (1, 7))
    assert one == pytest.approx(many, rel=1e-5)


def test_scores_without_training_documents(spark):
    held = [d for d in range(60) if zlib.crc32(str(d).encode()) % 7 == 2]
    rows = score_documents(spark.createDataFrame([(d, "a b c", "x", 1) for d in held], DOCS)).collect()
    assert len(rows) == len(held) and all(r.held_out and np.isfinite(r.score) and (r.n_known, r.train_tokens) == (0, 0) for r in rows)


# Shards

def test_shards(spark):
    r = random.Random(1)
    docs = [(k, "é" * r.randint(0, 60)) for k in range(300)] + [(5, "same")] * 120 + [(None, None), (999, "x" * 5000)]
    rows = shard_documents(spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS), 1000).collect()
    assert Counter((x.doc_id, x.n_bytes) for x in rows) == Counter((d, len((t or "").encode())) for d, t in docs)
    sizes = Counter()
    for x in rows:
        sizes[x.shard] += x.n_bytes
        assert len(x.shard) == x.depth
    assert all(sizes[x.shard] == x.shard_bytes and (x.shard_bytes > 1000) == x.over_limit for x in rows)
    assert [x.doc_id for x in rows if x.over_limit] == [999]
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))  # a prefix code
    parents = Counter()
    for x in rows:
        for d in range(x.depth):
            parents[x.shard[:d]] += x.n_bytes
    assert all(parents[s[:-1]] > 1000 for s in names if s)  # only oversized buckets split
    whole = shard_documents(spark.createDataFrame([(1, "a", "x", 1)], DOCS), 1000).collect()
    assert [(x.shard, x.depth) for x in whole] == [("", 0)]
    assert shard_documents(spark.createDataFrame([], DOCS), 1000).count() == 0


def test_the_shard_query_splits_buckets(spark, tmp_path):
    from pulsekit.llm.queries import op8_extendible_sharding
    docs = [(k, "x" * 100_000, "x", 1) for k in range(20)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op8_extendible_sharding(spark, str(tmp_path)).collect()
    assert len(rows) == 20 and min(x.depth for x in rows) > 0 and max(x.shard_bytes for x in rows) <= 256 << 10


def test_shards_are_written(spark, tmp_path):
    r = random.Random(2)
    docs = [(k, "é" * r.randint(0, 60), "x", k) for k in range(200)] + [(5, "same", "x", 1)] * 20 + [(None, None, "x", 2)]
    assigned = write_shards(spark.createDataFrame(docs, DOCS), f"{tmp_path}/out", 1000)
    written = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((x.doc_id, x.text, x.rid, x.n_chars) for x in written) == Counter(docs)
    sizes = Counter()
    for x in written:
        sizes[x.shard[1:]] += len((x.text or "").encode())
    assert dict(sizes) == {x.shard: x.shard_bytes for x in assigned.collect()} and max(sizes.values()) <= 1000


# URL rules

def test_url_parts(spark):
    urls = [None, "", "no scheme/x", "HTTP://WWW.É.Org", "a://b.C?x=/y", "a://b#c/d", "a://h/P/q?r#s", "x://y://z/w"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = url_parts(frame.url)
    got = [tuple(r) for r in frame.select(host, path).collect()]
    assert got == [("", ""), ("", ""), ("", ""), ("www.É.org", ""), ("b.c", ""), ("b", ""), ("h", "/P/q"), ("y:", "//z/w")]


def test_url_rules(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("block", "com", "/de/")]
    urls = [f"http://a{k % 5}.example.org/es/{k}" for k in range(40)] + [f"http://b.example.org/fr/{k}" for k in range(40)]
    urls += ["http://c.example.net/es/7", "http://c.example.net/fr/7", "http://c.example.net/xx", None, "http://notexample.org/es/1",
             "https://example.org/en/12", "https://example.org/en/2", "https://example.org"]
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)] + [(80, urls[80], "x", "y"), (None, None, "x", "y")],
                                  "page_id long, url string, host string, rule string")
    rows = filter_urls(pages, rules).collect()
    assert len(rows) == len(urls) + 2
    got = {r.page_id: (r.rule, r.verdict, r.mined) for r in rows}
    assert got[0] == ("example.org/es/", "block", False) and got[40] == ("org/", "allow", False)
    assert got[80] == (None, "block", True) and got[81] == (None, "allow", True) and got[83] == (None, "allow", False)
    assert [got[k][:2] for k in (84, 85, 86, 87)] == [("org/", "allow"), ("example.org/en/1", "block"), ("org/", "allow"), (None, "allow")]
    assert filter_urls(pages.limit(0), rules).count() == 0
    assert all(r.verdict == "allow" and not r.mined for r in filter_urls(pages, []).collect())


def test_mined_rules_have_their_confidence(spark):
    r = random.Random(9)
    baskets = [([f"t{k}" for k in range(5) if r.random() < 0.5], "block" if r.random() < 0.4 else "allow") for _ in range(200)]
    baskets += [(["t0", "t9"], "block")] * 30
    found = mine_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string"), 0.02, 0.8).collect()
    assert found
    for x in found:
        hold = [v for tokens, v in baskets if set(x.antecedent) <= set(tokens)]
        assert x.confidence == pytest.approx(hold.count(x.verdict) / len(hold)) and x.confidence >= 0.8
        assert x.support == pytest.approx(hold.count(x.verdict) / len(baskets)) and x.support >= 0.02
    sets = {frozenset(x.antecedent): x for x in found}
    assert not any(a < b and sets[a].verdict == sets[b].verdict and sets[a].confidence >= sets[b].confidence for a in sets for b in sets)


def test_rules_of_many_tokens(spark):
    """Only all five tokens together tell a blocked page: no shorter antecedent reaches the confidence."""
    baskets = [(["a", "b", "c", "d", "e"], "block")] * 6
    baskets += [([t for t in "abcde" if t != left], "allow") for left in "abcde"] * 6
    found = mine_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string"), 0.02, 0.8).collect()
    assert ["a", "b", "c", "d", "e"] in [x.antecedent for x in found if x.verdict == "block"]


# Pipeline

def test_pipeline(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs, kept = source, None
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.dtypes == source.dtypes
            kept = {r.doc_id: r for r in docs.collect()}
        if name == "quality_rules":
            for d, r in before.items():
                n, _, symbols, _, repeated = _quality(r.text)
                if d in kept:
                    assert n >= 50 and 100 * repeated <= 50 * n and 10 * symbols <= n
        elif name == "near_dedup":
            assert set(kept) == {c for _, _, c in brute_components(sorted((d, r.text) for d, r in before.items()), 80)}
        elif name == "decontamination":
            assert set(kept) == {d for d, r in before.items() if not brute_hits(r.text, items)[3]}
        elif name == "personal_data":
            assert set(kept) == set(before)
            for d, r in before.items():
                assert kept[d].n_chars == len(kept[d].text)
                assert (kept[d].text == r.text) or brute_base(r.text) and not brute_base(kept[d].text)
        else:
            whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            pieces = docs.orderBy("doc_id", "piece").collect()
            for d, r in kept.items():
                ids = np.array(whole.encode(r.text, add_special_tokens=False).ids + [0], "<u4").tobytes()
                assert b"".join(p.ids for p in pieces if p.doc_id == d) == ids
            assert max(Counter({p.sequence_id: p.offset + p.length for p in sorted(pieces, key=lambda p: p.offset)}).values()) <= 2048
    assert corpus_pipeline.run(spark, sf).count() == len(pieces)


def _quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    repeated = {k + o for k in range(len(w) - 2) for o in range(3) if windows[tuple(w[k:k + 3])] > 1}
    return len(w), None, len(re.findall(r"[#*$%&|<>]", text)), None, len(repeated)


def test_identifiers_side_by_side():
    text = "card 7536784127813050 4845168114407329 and +1 (826) 555-4081 190.137.223.204"
    base = base_spans(text)
    assert [k for _, k, _ in base] == ["ip"]
    strings = {(text[s:e], tuple(kinds)) for s, e, kinds in candidates(text, base)}
    assert {("7536784127813050", ("card",)), ("4845168114407329", ("card",)), ("+1 (826) 555-4081", ("phone",))} <= strings
    assert not any(s < b and a < e for s, e, _ in candidates(text, base) for a, _, b in base)
    long = "7 " * 3000
    assert len(candidates(long, [])) < 3000 * 19 and candidates("", []) == []


def test_contexts_take_whole_words():
    words_ = "x" * 90 + "1 " + "y" * 90 + "2"
    for text in (f"{words_} 5551234567 {'z' * 70}1", f"{words_} 5551234567 {'z' * 70}2"):
        start = text.index("555")
        seen = contexts(_Words(text), start, start + 10)
        assert len(set(seen)) == 2
    other = contexts(_Words(text.replace("2 555", "3 555")), start, start + 10)
    assert other[0] != seen[0] and other[1] != seen[1]
    assert contexts(_Words("tel:555 x"), 4, 7) == ["^ tel: _", "tel: _ x"] and contexts(_Words("555"), 0, 3) == ["^ ^ _", "^ _ $"]


def test_patterns_spread_until_nothing_grows(spark):
    """A chain of four contexts, each known only through instances that it shares with the one before."""
    sizes = [27, 9, 3, 1]
    groups = [[f"{k + 1}{n:09}" for n in range(size)] for k, size in enumerate(sizes)]
    around = ["in ma {} qa", "in mb {} qb", "in mc {} qc", "in md {} qd"]
    docs = [around[0].format(f"+1202555{k:04}") for k in range(81)]
    for k, group in enumerate(groups):
        docs += [a.format(v) for v in group for a in around[k:k + 2]]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(docs)], DOCS)
    got = [find_pii(frame, rounds=n, min_confidence=0.3, min_instances=1).select(F.sum(F.size("added"))).first()[0] for n in (1, 3, None)]
    assert got == [27, 27 + 36 + 12, 27 + 36 + 12 + 4]


def test_items_digest_is_of_sorted_strings(spark):
    docs = spark.createDataFrame([(1, "q w e", "x", 1)], DOCS)
    benchmark = spark.createDataFrame([(10, "q"), (9, "w e"), (2, "e")], "item_id long, text string")
    row = benchmark_hits(docs, benchmark).selectExpr("sha2(concat_ws(',', items), 256) AS h").first()
    assert row.h == hashlib.sha256(b"10,2,9").hexdigest()
