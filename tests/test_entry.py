import math
import os
from collections import Counter

import duckdb
import pandas as pd

import __spark_entry__ as entry_mod
from pulsekit.plans import catalog
from tests.conftest import SF_SMALL

HEAVY = {"shap_random_forest", "model_comparison_v3", "train_v2_feature_importance", "train_v1_metrics", "tune_forest_grid"}
# The training-data queries run in tests/llm.


def norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        r = round(v, 6)
        return 0.0 if r == 0 else r
    return v.item() if hasattr(v, "item") else v


def multiset(pdf):
    cols = sorted(pdf.columns)
    return cols, Counter(tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None))


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "Steps_Median" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_oracles_agree_at_sf0001(spark):
    con = duckdb.connect()
    for name in os.listdir(SF_SMALL):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, name)}')")
    failures = []
    for name, sql in catalog.ORACLES.items():
        got = multiset(entry_mod.queries()[name](spark, SF_SMALL).toPandas())
        want = multiset(con.execute(sql).df())
        if got != want:
            failures.append(name)
    assert failures == []


def test_rows_only_queries_run(spark):
    for name, fn in entry_mod.queries().items():
        if name in entry_mod.oracle_sql() or name in HEAVY or name not in catalog.QUERIES:
            continue
        assert fn(spark, SF_SMALL).count() >= 1, name
