"""Licence scans, fill-in-middle and conversation tries against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsekit.llm import prefix_trie as trie_module
from pulsekit.llm import rank_index
from pulsekit.llm.fim import fill_in_middle, restored, unit_ends
from pulsekit.llm.license_scan import NOTICES, Template, phrase_templates, scan_licences, template_words
from pulsekit.llm.prefix_trie import prefix_trie
from pulsekit.llm.radix_tree import RadixTree

DOCS = "doc_id long, text string, words string, output string, n int"
LOWER = {k: k + 32 for k in range(65, 91)}
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]


# Licences

def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_licences(docs, notices=NOTICES):
    """Every template compared at every place; scores at the places of the template's rarest key word."""
    words = [alnum(t) for _, t in docs]
    templates = [*phrase_templates(PHRASES), *notices]
    uses = Counter(w for ws in words for w in set(ws))
    out = []
    for (doc_id, _), ws in zip(docs, words, strict=True):
        base, labels, score = [], set(), 0.0
        for t, template in enumerate(templates):
            body = template_words(template)
            weight = [1 + round(1000 * math.log((len(docs) + 1) / (uses[w] + 1))) for w, _ in body]
            rare = min((-x, w) for x, (w, key) in zip(weight, body, strict=True) if key)[1]
            for s in range(-len(body), len(ws)):
                same = [0 <= s + k < len(ws) and ws[s + k] == w for k, (w, _) in enumerate(body)]
                share = sum(x for x, hit in zip(weight, same, strict=True) if hit)
                if any(hit and key and w == rare for hit, (w, key) in zip(same, body, strict=True)):
                    score = max(score, share / sum(weight))
                if all(hit for hit, (_, key) in zip(same, body, strict=True) if key):
                    if t < len(PHRASES):
                        base.append((s, template.label))
                    elif 100 * share >= 50 * sum(weight):
                        labels.add(template.label)
        own = {x for _, x in base}
        out.append((doc_id, len(ws), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                    sorted(own), sorted(own | labels), round(score, 9)))
    return out


def test_licences(spark):
    r = random.Random(3)
    pool = "the under license apache version 2 0 gnu general public cc by nc mit and é 使 permission is".split()
    texts = ["", None, "  ", "MIT-License", "mit license mit license", "cc by cc  BY nc", "license apache", "İmit license",
             NOTICES[2].text, "released " + NOTICES[-3].text + " x", "under the Apache License, Version 2.0.", "cc0 1 0", "\x00cc\x7fby",
             "word " * 30000 + "apache license"]
    texts += [" ".join(r.choice(pool) for _ in range(r.randint(1, 60))) for _ in range(60)]
    texts += [x for n in NOTICES for x in (n.text, "junk " + n.text.replace(" the ", " a "), n.text[len(n.text) // 3:])]
    docs = [*enumerate(texts), (3, "MIT-License"), (None, "gnu general public license")]
    rows = scan_licences(spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs], DOCS), PHRASES).collect()
    got = sorted(((*x[:5], list(x.base_labels), list(x.labels), round(x.score, 9)) for x in rows), key=str)
    assert got == sorted(brute_licences(docs), key=str)
    assert scan_licences(spark.createDataFrame([], DOCS), PHRASES).count() == 0


def test_notice_needs_its_key_phrases_and_weight(spark):
    notice = Template("x", "aa bb cc dd ee", ("bb cc",))
    texts = ["aa bb cc dd ee", "aa bb cc dd zz", "zz bb cc zz zz", "aa bb zz dd ee", "bb cc dd ee"]
    rows = scan_licences(spark.createDataFrame([(k, t, "x", "y", 1) for k, t in enumerate(texts)], DOCS), [("q q", "q")], [notice]).collect()
    assert {x.doc_id: list(x.labels) for x in rows} == {0: ["x"], 1: ["x"], 2: [], 3: [], 4: ["x"]}
    with pytest.raises(ValueError):
        template_words(Template("x", "a b", ("b a",)))


# Fill-in-middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def fim_docs():
    r = random.Random(8)
    pieces = [" ", "\n", "\t", "a", "é", "使", "𝄞", "\x00", "\x85", "<", "P>", "<P", ">", "S", "\x1c", "word"]
    texts = ["", None, " ", "\n \n", "x", " x ", "<P>", "a <S> b", "<M", "<" * 40, "long " * 40000, "使" * 30000, "y" * 5000 + " z" * 5000]
    texts += ["".join(r.choice(pieces) for _ in range(r.randint(1, 300))) for _ in range(300)]
    return [*enumerate(texts), (20, texts[20]), (None, "null id a b c"), (-4, "a b c")]


def test_fill_in_middle(spark):
    docs = fim_docs()
    frame = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs], DOCS)
    rows = fill_in_middle(frame).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted(((x.doc_id, x.n, x.form, x.prefix_chars, x.middle_chars, x.output) for x in rows), key=str) == \
        sorted((brute_fim(d, t) for d, t in docs), key=str)
    assert Counter(x.back for x in rows) == Counter(t or "" for _, t in docs)
    assert {x.form for x in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle(frame.limit(0)).count() == 0


def test_units_in_pieces(monkeypatch):
    monkeypatch.setattr("pulsekit.llm.fim.BLOCK_BYTES", 7)
    texts = [t or "" for _, t in fim_docs()[:9] + fim_docs()[13:]]
    chars, units = unit_ends(pa.array(texts, pa.large_string()))
    start = 0
    for k, t in enumerate(texts):
        assert list(chars[units[k]:units[k + 1]] - start) == list(np.cumsum([len(u) for u in UNIT.findall(t)]))
        start += len(t)


@pytest.mark.parametrize("max_error", [0, 1, 120, 400])
def test_rank_index_is_exact_and_bounded(max_error):
    r = np.random.default_rng(5)
    for steps in (r.integers(1, 12, 5000), r.integers(1, 900, 3000), np.ones(200, int), np.array([], int), np.array([3, 10**6, 1, 1, 10**6])):
        offsets = np.append(0, np.cumsum(steps))
        index = rank_index.fit(offsets, max_error)
        assert [index.offset(k) for k in range(len(offsets))] == offsets.tolist()
        assert np.abs(index.residual).max() <= max_error + 1
    assert len(rank_index.fit(np.arange(100000) * 6, 120).first) == 1
    assert len(rank_index.fit(np.append(0, np.cumsum(r.integers(1, 12, 100000))), 120).first) < 200


# Radix tree

def test_radix_tree():
    r = random.Random(2)
    keys = [bytes(r.choice([0, 1, 255, *range(r.choice([2, 10, 40, 200]))]) for _ in range(r.randint(0, 6))) for _ in range(6000)]
    keys += [b"", b"abc", b"abc", b"ab", b"x" * 500, b"x" * 499 + b"y"]
    tree = RadixTree()
    for k, key in enumerate(keys):
        tree.insert(key, k)
    want, got = defaultdict(list), {}
    for k, key in enumerate(keys):
        want[key].append(k)
    layouts = set()

    def walk(node, before):
        here = before + node.path
        layouts.add(node.layout)
        if node.values:
            got[here] = node.values
        found = {b: node.find(b) for b in range(256) if node.find(b)}
        assert len(found) == len(list(node.each())) <= node.layout and (len(found) > 1 or node.values or not before)
        for b, child in found.items():
            walk(child, here + bytes([b]))

    walk(tree.root, b"")
    assert got == dict(want) and layouts == {4, 16, 48, 256}
    assert all(end == len(tree.nodes()[parent][0].path) + 1 + len(node.path) for node, parent, end in tree.nodes() if parent == 0 and not tree.root.path)


# Conversation tries

CONV = "conv_id long, turn long, role string, text string, depth int, z1 string"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute_trie(rows, family=5, most=8):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, turn_id(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        full[c] = own.get(c - int(math.fmod(c, family)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(full[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def conversations(seed, n, longest):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-20, 4 * n), n):
        for k in range(r.randint(1, longest)):
            rows.append((c, k, r.choice(["user", "assistant", None]) if r.random() < 0.3 else "user", r.choice(["a", "é", "long text", None, ""])))
    rows += [(7, None, "user", "first"), (7, 0, "user", "b"), (7, 0, "user", "b"), (None, 0, "user", "lost"), (10**12, 5, None, None)]
    return rows


@pytest.mark.parametrize(("longest", "piece_turns", "tree_turns", "chunk_ids"), [(12, 256, 1 << 17, 1 << 14), (25, 3, 10, 2), (12, 1, 1, 1)])
def test_prefix_trie(spark, monkeypatch, longest, piece_turns, tree_turns, chunk_ids):
    monkeypatch.setattr(trie_module, "TREE_TURNS", tree_turns)
    monkeypatch.setattr(trie_module, "CHUNK_IDS", chunk_ids)
    rows = conversations(longest, 60, longest)
    frame = spark.createDataFrame([(*x, 1, "z") for x in rows], CONV).repartition(5)
    got = sorted(tuple(x) for x in prefix_trie(frame, piece_turns=piece_turns).collect())
    want = brute_trie(rows)
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_prefix_trie_of_one_long_conversation_and_many_copies(spark):
    rows = [(3, k, "user", f"t{k % 3}") for k in range(700)] + [(100 + c, k, "user", f"s{k}") for c in range(120) for k in range(2)]
    rows += [(3, 5, "user", "t0")] * 50
    frame = spark.createDataFrame([(*x, 1, "z") for x in rows], CONV).repartition(7)
    got = sorted(map(str, (tuple(x) for x in prefix_trie(frame, piece_turns=16).collect())))
    assert got == sorted(map(str, brute_trie(rows)))


def test_prefix_trie_of_nothing(spark):
    assert prefix_trie(spark.createDataFrame([], CONV)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b", 1, "z")], CONV)).count() == 0
    (root,) = prefix_trie(spark.createDataFrame([(4, 0, "a", "b", 1, "z")], CONV)).where("depth = 0").collect()
    assert (root.conv_id, root.parent_conv_id, root.n_convs) == (4, None, 1)
