import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pulsekit.operators import clean as cl
from pulsekit.operators import profile as pr

NUM = ["Steps", "Heart_Rate_avg", "Calories_Burned"]
ROWS = [
    (1, 100, 60.0, 10.0, "Cardio"),
    (2, 200, 70.0, 20.0, "Cardio"),
    (3, 300, 80.0, None, "Yoga"),
    (4, None, 90.0, 40.0, "Yoga"),
    (5, 500, None, 50.0, None),
    (6, -1, 100.0, 60.0, "None"),
]


def test_numeric_monitoring_exact_median(make):
    row = pr.numeric_monitoring(make(ROWS), NUM).first()
    assert row["Steps_Median"] == 200.0  # values -1,100,200,300,500 -> discrete median
    assert row["Heart_Rate_avg_Median"] == 80.0  # 60,70,80,90,100
    assert row["Calories_Burned_Median"] == 40.0  # 10,20,40,50,60 -> third of five
    assert math.isclose(row["Steps_Mean"], (100 + 200 + 300 + 500 - 1) / 5)
    assert row["Steps_Min"] == -1 and row["Steps_Max"] == 500
    assert math.isclose(row["Steps_Variance"], row["Steps_StdDev"] ** 2)


def test_numeric_monitoring_even_count_takes_lower_median(make):
    row = pr.numeric_monitoring(make(ROWS[:4]), ["Heart_Rate_avg"]).first()
    assert row["Heart_Rate_avg_Median"] == 70.0


def test_numeric_monitoring_approx_mode(make):
    row = pr.numeric_monitoring(make(ROWS), NUM, median="approx").first()
    assert row["Steps_Median"] == 200.0


def test_numeric_monitoring_empty_and_one_row(make):
    empty = pr.numeric_monitoring(make([]), NUM).collect()
    assert len(empty) == 1 and empty[0]["Steps_Mean"] is None and empty[0]["Steps_Median"] is None
    one = pr.numeric_monitoring(make(ROWS[:1]), NUM).first()
    assert one["Steps_Median"] == 100.0 and one["Steps_StdDev"] is None


def test_categorical_monitoring_null_counts_and_ties(make):
    rows = [(1, 0, 0.0, 0.0, "b"), (2, 0, 0.0, 0.0, "a"), (3, 0, 0.0, 0.0, None), (4, 0, 0.0, 0.0, None)]
    row = pr.categorical_monitoring(make(rows), "Workout_Type").first()
    assert row["Mode"] is None  # the NULL group is the largest
    assert row["Unique_Count"] == 2
    assert row["Missing_Rate"] == 0.5
    tie = pr.categorical_monitoring(make(rows[:2]), "Workout_Type").first()
    assert tie["Mode"] == "a"  # tie broken by value
    assert pr.categorical_monitoring(make([]), "Workout_Type").first()["Missing_Rate"] is None


def test_class_distribution_and_imbalance(make):
    dist = pr.class_distribution(make(ROWS), "Workout_Type").collect()
    assert [(r["Workout_Type"], r["count"]) for r in dist] == [("Cardio", 2), ("Yoga", 2), ("None", 1), (None, 1)]
    imb = pr.class_imbalance(make(ROWS), "Workout_Type").first()
    assert imb["max_count"] == 2 and imb["min_count"] == 1 and imb["imbalance_ratio"] == 2.0 and not imb["severe"]


def test_correlation_constant_column_is_null(make):
    rows = [(i, 5, float(i), float(2 * i), "x") for i in range(5)]
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in pr.correlation_matrix(make(rows), NUM).collect()}
    assert corr[("Steps", "Heart_Rate_avg")] is None
    assert math.isclose(corr[("Heart_Rate_avg", "Calories_Burned")], 1.0)
    assert len(corr) == 9


def test_outliers_and_per_class(make):
    rows = [(i, 10, 70.0, 5.0, "a") for i in range(30)] + [(99, 10, 70.0, 1000.0, "b")]
    rep = {r["column"]: r for r in pr.outlier_report(make(rows), NUM).collect()}
    assert rep["Calories_Burned"]["outliers"] == 1 and rep["Steps"]["outliers"] == 0
    per = pr.per_class_describe(make(ROWS), NUM, "Workout_Type").collect()
    assert {r["Workout_Type"] for r in per} == {"Cardio", "Yoga", "None"}


def test_cleaning_report_and_null_profile(make):
    clean_df, report = cl.validate_and_clean(make(ROWS), cl.LOOSE_RULES)
    assert sorted(r["row_id"] for r in clean_df.collect()) == [1, 2]
    rep = report.first()
    assert (rep["initial_count"], rep["after_dropna"], rep["final_count"]) == (6, 3, 2)
    assert math.isclose(rep["filter_removed_pct"], 100 / 3)
    empty = cl.cleaning_report(make([]), cl.LOOSE_RULES).first()
    assert empty["dropna_removed_pct"] is None
    nulls = {r["column"]: r["null_count"] for r in cl.null_profile(make(ROWS)).collect()}
    assert nulls == {"row_id": 0, "Steps": 1, "Heart_Rate_avg": 1, "Calories_Burned": 1, "Workout_Type": 1}


def test_strict_rules_are_inclusive(make):
    rows = [(1, 0, 50.0, 0.0, "a"), (2, 50000, 220.0, 5000.0, "a"), (3, 50001, 100.0, 1.0, "a")]
    assert sorted(r["row_id"] for r in cl.clean(make(rows), cl.STRICT_RULES).collect()) == [1, 2]


def test_num_classes_counts_null(make):
    assert pr.num_classes(make(ROWS), "Workout_Type").first()["num_classes"] == 4


def test_numeric_monitoring_bracket_and_full_agree(make):
    rows = [(i, (i * 37) % 101, float((i * 13) % 17), float(i % 7), "a") for i in range(300)]
    a = pr.numeric_monitoring(make(rows), NUM).first().asDict()
    b = pr.numeric_monitoring(make(rows), NUM, bracket=False).first().asDict()
    assert a == b


def test_correlation_of_many_columns_matches_pandas(spark):
    rng = np.random.default_rng(31)
    base = rng.normal(1e6, 1, (400, 60))
    base[:, 1:] += base[:, :1]
    base[rng.random(base.shape) < 0.2] = np.nan
    base[:, 7] = 0.1
    names = [f"c{i}" for i in range(60)]
    pdf = pd.DataFrame(base, columns=names)
    df = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in base],
                               ", ".join(f"{n} double" for n in names)).repartition(7)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in pr.correlation_matrix(df, names).collect()}
    want = pdf.corr()
    assert len(got) == 3600
    for (a, b), r in got.items():
        if "c7" in (a, b):
            assert r is None
        else:
            assert abs(r - want.loc[a, b]) < 1e-9


def test_correlation_of_no_rows_disjoint_columns_and_infinities(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [r["corr"] for r in pr.correlation_matrix(empty, ["a", "b"]).collect()] == [None] * 4
    df = spark.createDataFrame([(1.0, None, 1.0), (2.0, None, 5.0), (None, 3.0, math.inf), (None, 5.0, 2.0)], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in pr.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None and got["a", "c"] == got["c", "a"] and abs(got["a", "c"] - 1) < 1e-12
    assert math.isnan(got["b", "c"]) and math.isnan(got["c", "c"]) and abs(got["b", "b"] - 1) < 1e-12


def test_correlation_of_200_columns_runs(spark):
    names = [f"c{i}" for i in range(200)]
    df = spark.range(300).select(*[F.hash("id", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)])
    assert pr.correlation_matrix(df, names).where("corr is not null").count() == 40_000
