"""Every pipeline stage over nulls, empty and repeated rows, clashing column names and empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
EXTRA = ["rid", "dropped", "spans", "redacted", "rejected_by", "part", "length", "kept", "component_id", "n"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"{c} string" for c in EXTRA)
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def texts(spark):
    """Three different clean texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name in ("quality_rules", "near_dedup", "decontamination"):
        docs = STAGE[name](spark, docs, SF)
    found = [r.text for r in docs.where(~F.col("text").contains("@") & (F.length("text") < 4000)).orderBy("doc_id").limit(3).collect()]
    assert len(set(found)) == 3
    return found


def _table(spark, rows):
    return spark.createDataFrame([(d, t, None, "s", None if t is None else len(t), *[f"{c}-{d}" for c in EXTRA]) for d, t in rows], SCHEMA)


def _run(spark, name, docs):
    out = STAGE[name](spark, docs, SF)
    if name != "packing":
        assert out.dtypes == docs.dtypes
        for r in out.collect():
            assert all(r[c] == f"{c}-{r.doc_id}" for c in EXTRA)
    return out


@pytest.mark.parametrize("name", list(STAGE))
def test_stage_of_an_empty_table(spark, name):
    docs = _table(spark, [(1, "x")]).limit(0)
    assert _run(spark, name, docs).count() == 0


def test_quality_stage(spark, texts):
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (2, None), (3, ""), (4, " \n\t "), (5, "few words")]
    got = _run(spark, "quality_rules", _table(spark, rows))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(rows[:3])


def test_near_dedup_stage(spark, texts):
    rows = [(2, texts[0]), (1, texts[0]), (3, texts[1]), (3, texts[1]), (None, texts[2]), (None, texts[2]), (4, None), (5, ""), (6, "")]
    got = _run(spark, "near_dedup", _table(spark, rows).repartition(3))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, texts[0]), (3, texts[1]), *rows[4:]])


def test_decontamination_stage(spark, texts):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("size(split(text, ' ')) >= 13").orderBy("item_id").first().text
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (2, None), (3, ""), (4, item), (4, item), (None, item.upper())]
    got = _run(spark, "decontamination", _table(spark, rows))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(rows[:5])


def test_personal_data_stage(spark, texts):
    rows = [(1, "write to ann@example.org now"), (1, "write to ann@example.org now"), (None, texts[0]), (2, None), (3, "")]
    got = _run(spark, "personal_data", _table(spark, rows)).collect()
    assert Counter((r.doc_id, r.text is None) for r in got) == Counter((d, t is None) for d, t in rows)
    ones = [r for r in got if r.doc_id == 1]
    assert all("ann@" not in r.text and r.text.startswith("write to ") and r.n_chars == len(r.text) for r in ones)
    assert {r.text for r in got if r.doc_id == 3} == {""}


def test_packing_stage(spark, texts):
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (2, None), (3, ""), (4, texts[2] + " " + "word " * 9000)]
    got = _run(spark, "packing", _table(spark, rows)).collect()
    pieces = Counter(r.doc_id for r in got)
    assert pieces[1] >= 2 and pieces[None] >= 1 and pieces[4] >= 4
    assert [(r.length, r.start) for r in got if r.doc_id in (2, 3)] == [(1, 0)] * 2
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
