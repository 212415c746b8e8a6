import numpy as np
from pyspark.sql import functions as F

from pulsekit.operators.ordered import cumulative_by_value, quantile_disc


def test_cumulative_matches_numpy_with_heavy_value(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.integers(0, 300, 3000), np.full(3000, 42)]).astype(float)  # one value holds half
    grp = rng.integers(0, 2, len(vals))
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, v double") \
        .withColumn("w", F.lit(1).cast("long"))
    out = cumulative_by_value(df, ["g"], "v", ["w"], num_partitions=5).toPandas()
    for g in (0, 1):
        sub = out[out.g == g].sort_values("v")
        expected = [(vals[grp == g] <= v).sum() for v in sub.v]
        assert list(sub.cum_w) == expected


def test_quantile_disc_infinite_and_large_integers(spark):
    inf = float("inf")
    for rows in ([inf, inf, 1.0], [-inf, -inf, 1.0], [inf], [1.0, 2.0, inf, -inf, 3.0]):
        df = spark.createDataFrame([(v,) for v in rows], "v double")
        assert quantile_disc(df, [], "v", 0.5).first()["quantile"] == sorted(rows)[(len(rows) + 1) // 2 - 1]
    big = spark.createDataFrame([(9007199254740993,), (9007199254740993,), (1,)], "v long")
    assert quantile_disc(big, [], "v", 0.5).first()["quantile"] == 9007199254740993
    assert quantile_disc(big.limit(0), [], "v", 0.5).count() == 0


def test_quantile_disc_without_groups(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [5, 1, 3, 2, 4, None]], "v double")
    assert quantile_disc(df, [], "v", 0.5).first()["quantile"] == 3.0
    assert quantile_disc(df, [], "v", 1.0).first()["quantile"] == 5.0


def test_quantile_disc_bracket_matches_full_ranking(spark):
    rng = np.random.default_rng(21)
    vals = np.concatenate([rng.normal(0, 1, 20000).round(3), np.full(8000, 0.25)])  # a value holding 2/7 of rows
    grp = rng.integers(0, 3, len(vals))
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, v double")
    for p in (0.5, 0.1, 0.9, 0.0001, 1.0):
        br = {r["g"]: r["quantile"] for r in quantile_disc(df, ["g"], "v", p, bracket_accuracy=500).collect()}
        full = {r["g"]: r["quantile"] for r in quantile_disc(df, ["g"], "v", p, bracket_accuracy=None).collect()}
        assert br == full, p
        for g in range(3):
            s = np.sort(vals[grp == g])
            assert br[g] == s[max(int(np.ceil(p * len(s))) - 1, 0)]


def test_quantile_by_radix_equals_duckdb(spark):
    import duckdb
    import pyarrow as pa
    rng = np.random.default_rng(8)
    doubles = np.concatenate([rng.normal(0, 1e6, 400), rng.normal(0, 1e-300, 50), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308],
                              [np.inf] * 40, [-np.inf] * 40, np.repeat(rng.normal(0, 1, 5), 60)])
    longs = np.concatenate([rng.integers(-2**63, 2**63 - 1, 300), [2**63 - 1, -2**63, 0, -1], 2**53 + np.arange(9)])
    for values, kind in ((doubles, "double"), (longs, "long")):
        groups = [None if k % 4 == 3 else int(k % 4) for k in range(len(values))]
        rows = list(zip(groups, values.tolist(), strict=True)) + [(0, None), (9, None)]
        df = spark.createDataFrame(rows, f"g int, v {kind}")
        t = pa.table({"g": pa.array([r[0] for r in rows]), "v": pa.array([r[1] for r in rows])})  # noqa: F841
        for p in (0.0, 0.25, 0.5, 1.0):
            want = dict(duckdb.sql(f"SELECT g, quantile_disc(v, {p}) FROM t WHERE v IS NOT NULL GROUP BY g").fetchall())
            for bound in (None, 5):
                assert dict(quantile_disc(df, ["g"], "v", p, max_groups=bound).collect()) == want, (kind, p)


def test_quantile_of_nan_is_above_infinity(spark):
    df = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), 1.0)], "v double")
    assert quantile_disc(df, [], "v", 0.5).first()[0] == float("inf")
    assert np.isnan(quantile_disc(df, [], "v", 1.0).first()[0])
