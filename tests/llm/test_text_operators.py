"""HTML extraction, packing, token counts and quality rules against brute force, and their edge cases."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsekit.llm import common, tokens
from pulsekit.llm.html_extract import extract_main_text, main_text
from pulsekit.llm.packing import best_two_fit, pack_documents, patterns
from pulsekit.llm.quality import BASE_RULES, RULES, Measures, cascade_order, keep_quality, quality_measures, run_cascade
from pulsekit.llm.token_counts import count_tokens
from pulsekit.llm.tokens import ChunkEncoder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, ids string, sequence_id int, rejected_by string"


def odd_texts(n=150):
    r = random.Random(5)
    pieces = list(" \n\tab'st1é. 　") + ["<|endoftext|>", "<|startoftext|>", "  ", "don't", "\x1c", "\x85"]
    return ["", " ", "  ", *("".join(r.choice(pieces) for _ in range(r.randint(1, 40))) for _ in range(n))]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*odd_texts(), "word " * 5000, "x" * 20000]
    rows = [(k, t, "x", 1, "y") for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[7], (None, None, None, None, None), (900, None, "x", 2, "z")], DOCS)


# HTML

def test_article_keeps_its_own_links_and_named_parts():
    body = "<p>" + "A sentence, with commas, and words. " * 6 + "</p>"
    page = f"""<body><nav><a href=x>Home</a> <a href=y>News</a></nav><article><h1>T</h1>{body}<div class="related-work"><p>Earlier
    work.</p></div><p class="ad">Buy</p><div class="share-buttons">Tweet</div><h2>Sources</h2><ul><li><a href=1>First</a></li>
    <li><a href=2>Second</a></li></ul></article></body>"""
    text = main_text(page)
    assert text.endswith("Sources\n\nFirst\n\nSecond") and "Earlier work." in text
    assert not any(x in text for x in ("Home", "Buy", "Tweet"))
    links = "<div>" + "".join(f"<p><a href={k}>A paragraph, linked, {k} and long enough to count as one.</a></p>" for k in range(2)) + "</div>"
    assert main_text(f"<body>{links}</body>")


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<p>", ""), ("<!-- x", ""), ("<script>var a = '<p>x</p>';", ""), ("a < b <b>c</b>", "a < b c"),
    ("<div><p>one<p>two</div>", "one\n\ntwo"), ("<p>a &amp; b&nbsp;&#233;\n c</p>", "a & b é c"), ("<p>abc <di", "abc"),
    ("<article><p>x<br>y<table><tr><td>1<td>2</table></article>", "x y\n\n1\n\n2"),
    ("<nav>menu</nav><header>top</header><div class=ad>buy</div><article><h1>T</h1><p><b>Bold.<br><p>Next.</p></article>"
     "<aside>side</aside><footer>&copy; end</footer>", "T\n\nBold.\n\nNext."),
    ('<body><ul class="site-menu"><li>a</ul><div id="content"><h1>T</h1><p>Long enough, with commas, to be a paragraph.</p>'
     '<p>And &lt;more&gt;.</p></div><div class="userComments"><p>A comment, which is as long, as the others are.</p></div>'
     '<form><p>q<input></form><div role="alert">n</div>', "T\n\nLong enough, with commas, to be a paragraph.\n\nAnd <more>."),
    ("<p style='display:none'>h</p><p hidden>i</p><p title='a>b' class=x>shown</p>", "shown"),
])
def test_main_text(html, text):
    assert main_text(html) == text


def test_main_text_is_linear_on_broken_pages():
    for bad in ("<div>" * 30000 + "</b>" * 30000, '<a b="' * 30000, "<!--" * 30000, "<b>x" * 30000, "<p><a>x" * 30000):
        main_text(bad)


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>héllo", "c"), (2, None, None, "c"), (1, "u", "<p>héllo", "c"), (None, "v", "", "c")],
                                  "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in extract_main_text(pages).collect())
    assert got == [(0, "v", "", 0), (1, "u", "héllo", 5), (1, "u", "héllo", 5), (2, "", "", 0)]
    assert extract_main_text(pages.limit(0)).count() == 0


# Tokens and packing

def test_chunks_have_the_ids_of_the_whole_text():
    texts, whole = odd_texts(3000), Tokenizer.from_file(BYTE_BPE)
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    for ranks in (None, RANKS):
        assert [x.tolist() for x in ChunkEncoder(BYTE_BPE, ranks).encode(pa.array(texts, pa.large_string()))] == want


def test_ids_are_joined_in_bounded_runs(monkeypatch):
    texts, whole = odd_texts(300), Tokenizer.from_file(BYTE_BPE)
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    encoder = ChunkEncoder(BYTE_BPE, RANKS)
    rows, offsets = np.repeat(encoder._rows(["word"]), 2_000_000), np.arange(0, 2_000_001, 2000)
    tracemalloc.start()
    got = list(encoder._joined(rows, offsets))
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(got) == 1000 and all(len(x) == 2000 for x in got)
    assert peak - held < 8 << 20  # in one piece it takes some 80 MB beside the result
    monkeypatch.setattr(tokens, "JOINED_CHUNKS", 3)
    assert [x.tolist() for x in encoder.encode(pa.array(texts, pa.large_string()))] == want


@pytest.mark.parametrize("part_chars", [1, 1 << 16])
def test_distinct_chunks_go_to_the_rank_form_as_running_text(monkeypatch, part_chars):
    r = random.Random(8)
    words = [f"{r.choice(['w', 'é漢', 'a\nb', 'tail\n', "don't", '<|endoftext|>'])}{k}" for k in range(6000)]
    texts = [*(" ".join(r.choices(words, k=r.randint(0, 60))) for _ in range(400)), "", " ", "a  b", " " * 70 + "c"]
    want = [e.ids for e in Tokenizer.from_file(BYTE_BPE).encode_batch(texts, add_special_tokens=False)]
    encoder, calls = ChunkEncoder(BYTE_BPE, RANKS), []
    fast = encoder.fast
    encoder.fast = lambda text: calls.append(text) or fast(text)
    monkeypatch.setattr(tokens, "PART_CHARS", part_chars, raising=False)
    assert [x.tolist() for x in encoder.encode(pa.array(texts, pa.large_string()))] == want
    plain = [f"word{k}" for k in range(4000)]
    del calls[:]
    encoder.encode(pa.array([" ".join(plain[:2000]), " ".join(plain)], pa.large_string()))
    if part_chars > 1:  # the texts' first words and a text of the others; once a call for every chunk
        assert len(calls) <= 3 and sum(map(len, calls)) == len(" ".join(plain))


def test_white_space_that_the_rank_form_cannot_take():
    text = "x" + " " * 1_100_000 + "y"
    want = Tokenizer.from_file(BYTE_BPE).encode(text, add_special_tokens=False).ids
    assert ChunkEncoder(BYTE_BPE, RANKS).encode(pa.array([text, "z"], pa.large_string()))[0].tolist() == want


def test_workers_keep_the_objects_of_one_operator_and_trim_between_blocks(monkeypatch):
    made = []
    monkeypatch.setattr(common, "_KEPT", {})
    for owner, key in [("a", "x"), ("a", "y"), ("a", "x"), ("b", "x"), ("a", "x")]:
        assert common.kept(owner, key, lambda: made.append((owner, key)) or owner) == owner  # noqa: B023
    assert made == [("a", "x"), ("a", "y"), ("b", "x"), ("a", "x")]
    assert list(common._KEPT) == ["a"]
    trims = []
    monkeypatch.setattr(common, "trim_memory", lambda: trims.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 7)], names=["text"])
    assert sum(b.num_rows for b in common.blocks(iter([batch]), "text", 20)) == 7
    assert len(trims) == 5  # at the start, and after each of four slices


def test_best_two_fit_is_close_to_the_bound():
    r = np.random.default_rng(3)
    for capacity in (64, 2048):
        lengths = r.integers(1, capacity + 1, 3000) // r.integers(1, 6, 3000) + 1
        lengths = np.minimum(lengths, capacity)
        bins = best_two_fit(lengths, capacity)
        assert sorted(k for b in bins for k in b) == list(range(3000))
        assert max(lengths[b].sum() for b in bins) <= capacity
        assert len(bins) <= -(-lengths.sum() // capacity) * 1.01 + 1
    assert best_two_fit(np.zeros(0, np.int64), 8) == []
    # the smallest piece (2) makes room for two (1 and 3) that fill the bin
    assert sorted(sorted(x) for x in best_two_fit(np.array([6, 2, 1, 1]), 10)) == [[0, 1, 2, 3]]


@pytest.mark.parametrize("window", [1, 8 << 20])
def test_packing(docs, window):
    whole = Tokenizer.from_file(BYTE_BPE)
    got = pack_documents(docs, BYTE_BPE, capacity=256, window_ids=window, ranks=RANKS).toPandas()
    want = sorted(np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for r in docs.collect())
    assert int(got.length.sum()) * 4 == sum(map(len, want))
    assert (got.length <= 256).all() and (got.groupby("sequence_id").length.sum() <= 256).all()
    ordered = got.sort_values(["sequence_id", "offset"])
    assert ((ordered.offset == 0) | (ordered.offset == (ordered.offset + ordered.length).shift())).all()
    once = got[got.doc_id.notna() & (got.doc_id != 7)].sort_values(["doc_id", "piece"])
    for doc, pieces in once.groupby("doc_id"):
        assert b"".join(pieces.ids) in want, doc
        assert list(pieces.piece) == list(range(len(pieces))) and (pieces.length.iloc[1:] == 256).all()
        assert list(pieces.start) == [0, *pieces.length.cumsum().iloc[:-1]]


def test_patterns_pack_any_number_of_pieces():
    r = np.random.default_rng(5)
    count = np.concatenate([[0], r.integers(0, 10**9, 2048)])
    found = list(patterns(count, 2048))
    total = sum(n * int(count[n]) for n in range(2049))
    packed = Counter()
    for held, times in found:
        assert sum(held) <= 2048
        for n in held:
            packed[n] += times
    assert packed == +Counter(dict(enumerate(count.tolist())))
    assert len(found) < 30000 and sum(times for _, times in found) <= -(-total // 2048) * 1.01


def test_packing_does_not_depend_on_partitions(spark):
    r = random.Random(6)
    rows = [(k, " ".join(["word"] * r.choice([r.randint(1, 60), r.randint(60, 150), r.randint(1, 700)])), "x", 1, "y") for k in range(600)]
    n_sequences = {}
    for name, data, parts in (("one", rows, 1), ("few", rows, 13), ("many", rows, 400),
                              ("by length", sorted(rows, key=lambda x: len(x[1])), 13)):
        frame = spark.createDataFrame(spark.sparkContext.parallelize(data, parts), DOCS)
        got = pack_documents(frame, BYTE_BPE, capacity=256, ranks=RANKS).toPandas()
        assert got.groupby("sequence_id").length.sum().max() <= 256
        assert not got.duplicated(["sequence_id", "offset"]).any() and got.doc_id.nunique() == 600
        n_sequences[name] = got.sequence_id.nunique()
        bound = -(-int(got.length.sum()) // 256)
    assert len(set(n_sequences.values())) == 1 and n_sequences["one"] <= bound * 1.02 + 1


def test_packing_of_nothing(docs):
    assert pack_documents(docs.limit(0), BYTE_BPE).count() == 0


@pytest.mark.parametrize("head", [1, 1 << 17])
def test_token_counts(docs, head):
    whole = Tokenizer.from_file(WORD_BPE)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in count_tokens(docs, WORD_BPE, limit=2048, head_terms=head).collect())
    want = []
    for r in docs.collect():
        n = len(whole.encode(r.text or "", add_special_tokens=False).ids)
        want.append((-1 if r.doc_id is None else r.doc_id, len((r.text or "").encode()), n, n > 2048))
    assert got == sorted(want)


def test_token_counts_of_nothing(docs):
    assert count_tokens(docs.limit(0), WORD_BPE).count() == 0


# Quality

def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    repeated = {k + o for k, w in enumerate(windows) if windows.count(w) > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def quality_texts():
    r = random.Random(2)
    vocabulary = ["a", "be", "cé", "#x", "d|e", "F", "G!", "\n", "\n", "word"]
    return [None, "", " \n ", *(" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 90))) for _ in range(200)),
            " ".join(f"word{k}" for k in range(80)), " ".join(f"WORD{k}!" for k in range(80)), "same line\n" * 40]


def test_quality(spark):
    texts = quality_texts()
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(None, "a", "x")], "doc_id long, text string, rejected_by string")
    got = {r.doc_id: r for r in quality_measures(frame).collect()}
    assert len(got) == len(texts) + 1
    for k, t in enumerate(texts):
        r, want = got[k], brute_measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    kept = {r.doc_id for r in keep_quality(frame).collect()}
    assert kept == {k for k, r in got.items() if not r.base_failed and r.rejected_by is None} and len(texts) - 3 in kept
    assert keep_quality(frame).schema == frame.schema
    assert keep_quality(frame.limit(0)).count() == quality_measures(frame.limit(0)).count() == 0


def test_cascade_order_and_verdict(spark):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(quality_texts())], "doc_id long, text string")
    rows = cascade_order(frame).collect()
    assert {r.rule for r in rows} == {r.name for r in RULES}
    assert [r.gain for r in rows] == sorted((r.gain for r in rows), reverse=True)
    texts = pa.array([t or "" for t in quality_texts()], pa.large_string())
    rules = (*BASE_RULES, *RULES)
    bad = np.logical_or.reduce([r.rejects(Measures(texts)) for r in rules])
    for order in (rules, rules[::-1]):
        assert [v is not None for v in run_cascade(texts, order)] == bad.tolist()


def test_crc_of_ids_is_unsigned_little_endian(spark):
    frame = spark.createDataFrame([(1, "hello")], "doc_id long, text string")
    row = pack_documents(frame, BYTE_BPE).selectExpr("ids", "crc32(ids) AS c").first()
    assert row.c == zlib.crc32(np.frombuffer(row.ids, "<u4").astype("<u4").tobytes())
