import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pulsekit.sources import runs, tables


def test_upsert_replaces_by_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    source = spark.createDataFrame([("B", 2), ("D", 4)], "v string, k long")
    out = {r["k"]: r["v"] for r in tables.upsert(target, source, ["k"]).collect()}
    assert out == {1: "a", 2: "B", 3: "c", 4: "D"}


def test_upsert_refuses_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string")
    with pytest.raises(Exception, match="several rows for one key"):
        tables.upsert(target, source, ["k"]).collect()


def test_describe_and_snapshot(spark, tmp_out):
    df = spark.createDataFrame([(1, 2.0)], "a long, b double")
    desc = {r["col_name"]: r["data_type"] for r in tables.describe_columns(df).collect()}
    assert desc == {"a": "bigint", "b": "double"}
    path = os.path.join(tmp_out, "snap")
    tables.snapshot(df, path, as_table=False)
    assert tables.scan(spark, path, ["b"]).first()["b"] == 2.0


def test_run_log_roundtrip(spark, tmp_out):
    path = os.path.join(tmp_out, "runs")
    log = runs.RunLog(spark, path, run_id="r1")
    log.log_param("features", ["Steps"])
    log.log_metric("accuracy", 0.5)
    log.flush()
    metrics = spark.createDataFrame([("test", 0.7)], "split string, accuracy double")
    log.log_frame(metrics, ["split"], ["accuracy"])
    got = {r["key"]: r["value"] for r in log.read().where(F.col("run_id") == "r1").collect()}
    assert got == {"features": '["Steps"]', "accuracy": "0.5", "test_accuracy": "0.7"}


def test_model_save_load_with_signature(spark, tmp_out):
    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "x double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression(maxIter=5)]).fit(df)
    path = os.path.join(tmp_out, "model")
    runs.save_model(model, path, df, ["x"])
    loaded, sig = runs.load_model(spark, path)
    scoring = spark.createDataFrame([(3,)], "x int")
    conformed = runs.conform(scoring, sig)
    assert conformed.schema["x"].dataType.simpleString() == "double"
    assert loaded.transform(conformed).first()["prediction"] == model.transform(conformed).first()["prediction"]
    try:
        runs.conform(spark.createDataFrame([(1,)], "y int"), sig)
    except ValueError:
        pass
    else:
        raise AssertionError("missing signed column must raise")


def test_sql_select_and_describe_catalog_view(spark):
    spark.createDataFrame([(1, "x")], "a long, b string").createOrReplaceTempView("pk_tmp_view")
    assert tables.select_all(spark, "pk_tmp_view").count() == 1
    names = [r["col_name"] for r in tables.describe_table(spark, "pk_tmp_view").collect()]
    assert names[:2] == ["a", "b"]


def test_snapshot_as_catalog_table_and_describe(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "a long, b double")
    name = "pk_snapshot_test"
    try:
        tables.snapshot(df, name)
        tables.snapshot(df.where("a = 1"), name)  # replaces, not appends
        assert tables.select_all(spark, name).count() == 1
        info = {r["col_name"]: r["data_type"] for r in tables.describe_table(spark, name).collect()}
        assert info["a"] == "bigint" and "Type" in info  # extended section present
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _files(path):
    return {os.path.join(root, f): os.stat(os.path.join(root, f)).st_mtime_ns
            for root, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_table_rewrites_only_touched_buckets(spark, tmp_out):
    path = f"{tmp_out}/table"
    target = spark.range(1000).select((F.col("id") % 500).alias("k"), (F.col("id") >= 500).alias("half"), F.lit("old").alias("v"))
    tables.create_keyed_table(target, path, ["k", "half"], buckets=16)
    before = _files(path)
    source = spark.createDataFrame([("new", True, 3, 9), ("new", False, 7777, 9)], "v string, half boolean, k int, other int")
    touched = tables.upsert_table(spark, path, source)
    after = _files(path)
    assert 1 <= len(touched) <= 2
    for name, written in before.items():
        if not any(f"{tables.BUCKET}={t}/" in name for t in touched):
            assert after[name] == written
    got = {(r["k"], r["half"]): r["v"] for r in tables.read_keyed_table(spark, path).collect()}
    assert len(got) == 1001 and got[3, True] == got[7777, False] == "new"
    assert sum(v == "new" for v in got.values()) == 2
    tables.upsert_table(spark, path, source)  # again: no change
    assert {(r["k"], r["half"]): r["v"] for r in tables.read_keyed_table(spark, path).collect()} == got


def test_upsert_table_refuses_repeated_keys_and_takes_empty_and_null(spark, tmp_out):
    path = f"{tmp_out}/table"
    schema = "k long, v string"
    tables.create_keyed_table(spark.createDataFrame([(1, "a"), (None, "b")], schema), path, ["k"], buckets=4)
    before = _files(path)
    assert tables.upsert_table(spark, path, spark.createDataFrame([], schema)) == []
    with pytest.raises(Exception, match="several rows for one key"):
        tables.upsert_table(spark, path, spark.createDataFrame([(1, "x"), (1, "y")], schema))
    assert _files(path) == before
    tables.upsert_table(spark, path, spark.createDataFrame([(None, "c")], schema))
    rows = sorted((r["k"] is None, r["v"]) for r in tables.read_keyed_table(spark, path).collect())
    assert rows == [(False, "a"), (True, "b"), (True, "c")]
