"""Registered queries: each runs one library operator over the full test tables, with its DuckDB oracle.

A query is a function ``(spark, sf_dir) -> DataFrame``; the oracle is DuckDB SQL over views named like the parquet
files. Computed columns carry the same alias on both sides. Queries whose result depends on a trained model are
registered without an oracle (row-count check only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.hashing import hash01_sql_duckdb
from ..functions import expressions as ex
from ..operators import clean as cl
from ..operators import evaluate as ev
from ..operators import distribution as di
from ..operators import features as fe
from ..operators import profile as pr
from ..operators import sample as sa
from ..sources.fixtures import LABEL_COL, NUMERIC_COLS, activity, activity_cte, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NUM = NUMERIC_COLS
LAB = LABEL_COL
CTE = activity_cte()


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def d(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


# Oracle fragments for the cleaned views.
LOOSE_WHERE = ("Steps IS NOT NULL AND Heart_Rate_avg IS NOT NULL AND Calories_Burned IS NOT NULL "
               "AND Workout_Type IS NOT NULL AND Steps >= 0 AND Heart_Rate_avg > 0 AND Calories_Burned >= 0")
STRICT_WHERE = ("Steps IS NOT NULL AND Heart_Rate_avg IS NOT NULL AND Calories_Burned IS NOT NULL "
                "AND Workout_Type IS NOT NULL AND Steps BETWEEN 0 AND 50000 AND Heart_Rate_avg BETWEEN 50 AND 220 "
                "AND Calories_Burned BETWEEN 0 AND 5000")
CLEAN_CTE = (CTE.rstrip() + f",\nloose AS (SELECT * FROM activity WHERE {LOOSE_WHERE}),\n"
             f"strict AS (SELECT * FROM activity WHERE {STRICT_WHERE})\n")
ACTIVITY_COLS = ["row_id", *NUM, LAB]


def loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.clean(activity(spark, sf_dir), cl.LOOSE_RULES)


def strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.clean(activity(spark, sf_dir), cl.STRICT_RULES)


# ---------------------------------------------------------------- A: scans
@register("activity_scan", CTE + "SELECT * FROM activity")
def q_activity_scan(spark, sf_dir):
    return activity(spark, sf_dir)


# ---------------------------------------------------------------- C: monitoring and profile
def _numeric_monitoring_sql() -> str:
    parts = []
    for c in NUM:
        parts += [f"avg({d(c)}) AS {c}_Mean", f"CAST(quantile_disc({d(c)}, 0.5) AS DOUBLE) AS {c}_Median",
                  f"stddev_samp({d(c)}) AS {c}_StdDev", f"var_samp({d(c)}) AS {c}_Variance",
                  f"min({c}) AS {c}_Min", f"max({c}) AS {c}_Max"]
    return CTE + "SELECT " + ", ".join(parts) + " FROM activity"


@register("numeric_monitoring", _numeric_monitoring_sql())
def q_numeric_monitoring(spark, sf_dir):
    return pr.numeric_monitoring(activity(spark, sf_dir), NUM, median="exact")


@register("numeric_monitoring_approx")
def q_numeric_monitoring_approx(spark, sf_dir):
    """C1 with the reference's ``percentile_approx`` median (default accuracy); DuckDB's sketch differs: rows-only."""
    return pr.numeric_monitoring(activity(spark, sf_dir), NUM, median="approx")


@register("categorical_monitoring", CTE + f"""
, c AS (SELECT {LAB}, count(*) AS n FROM activity GROUP BY {LAB})
SELECT (SELECT {LAB} FROM c ORDER BY n DESC, {LAB} ASC NULLS LAST LIMIT 1) AS Mode,
       CAST(count({LAB}) AS BIGINT) AS Unique_Count,
       CAST(sum(CASE WHEN {LAB} IS NULL THEN n ELSE 0 END) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS Missing_Rate
FROM c""")
def q_categorical_monitoring(spark, sf_dir):
    return pr.categorical_monitoring(activity(spark, sf_dir), LAB)


@register("grouped_round_avg", CTE + f"""
SELECT round(avg({d('Calories_Burned')}), 2) AS avg_calories, {LAB} FROM activity GROUP BY {LAB}""")
def q_grouped_round_avg(spark, sf_dir):
    return pr.grouped_round_avg(activity(spark, sf_dir), "Calories_Burned", LAB, 2, "avg_calories")


@register("describe_numeric", CLEAN_CTE + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, avg({d(c)}) AS mean, stddev_samp({d(c)}) AS stddev,"
    f" min({d(c)}) AS min, max({d(c)}) AS max FROM loose" for c in NUM))
def q_describe_numeric(spark, sf_dir):
    return pr.describe_numeric(loose(spark, sf_dir), NUM)


@register("class_distribution", CLEAN_CTE + f"""
, c AS (SELECT {LAB}, CAST(count(*) AS BIGINT) AS count FROM loose GROUP BY {LAB})
SELECT {LAB}, count, CAST(count AS DOUBLE) / (SELECT CAST(sum(count) AS DOUBLE) FROM c) * 100 AS percentage FROM c""")
def q_class_distribution(spark, sf_dir):
    return pr.class_distribution(loose(spark, sf_dir), LAB)


@register("class_imbalance", CTE + f"""
, c AS (SELECT {LAB}, count(*) AS n FROM activity GROUP BY {LAB})
SELECT CAST(max(n) AS BIGINT) AS max_count, CAST(min(n) AS BIGINT) AS min_count, CAST(count(*) AS BIGINT) AS num_classes,
       CAST(max(n) AS DOUBLE) / CAST(min(n) AS DOUBLE) AS imbalance_ratio,
       CAST(max(n) AS DOUBLE) / CAST(min(n) AS DOUBLE) > 5.0 AS severe FROM c""")
def q_class_imbalance(spark, sf_dir):
    return pr.class_imbalance(activity(spark, sf_dir), LAB)


@register("per_class_describe", CTE + " UNION ALL ".join(
    f"SELECT {LAB}, '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, avg({d(c)}) AS mean,"
    f" stddev_samp({d(c)}) AS stddev, min({d(c)}) AS min, max({d(c)}) AS max"
    f" FROM activity WHERE {LAB} IS NOT NULL GROUP BY {LAB}" for c in NUM))
def q_per_class_describe(spark, sf_dir):
    return pr.per_class_describe(activity(spark, sf_dir), NUM, LAB)


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(NUM):
        for b in NUM[i:]:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            expr = (f"covar_pop({d(a)}, {d(b)}) / NULLIF(stddev_pop(CASE WHEN {both} THEN {d(a)} END) * "
                    f"stddev_pop(CASE WHEN {both} THEN {d(b)} END), 0)")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {expr} AS corr FROM activity")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {expr} AS corr FROM activity")
    return CTE + " UNION ALL ".join(parts)


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf_dir):
    return pr.correlation_matrix(activity(spark, sf_dir), NUM)


def _outlier_sql() -> str:
    parts = []
    for c in NUM:
        parts.append(f"""SELECT '{c}' AS column, s.m AS mean, s.s AS std, s.s * 3.0 AS threshold, s.lo AS min, s.hi AS max,
  CAST((SELECT count(*) FROM activity a WHERE {d('a.' + c)} > s.m + s.s * 3.0 OR {d('a.' + c)} < s.m - s.s * 3.0)
       AS BIGINT) AS outliers
FROM (SELECT avg({d(c)}) AS m, stddev_samp({d(c)}) AS s, min({d(c)}) AS lo, max({d(c)}) AS hi FROM activity) s""")
    return CTE + " UNION ALL ".join(parts)


@register("outlier_report", _outlier_sql())
def q_outlier_report(spark, sf_dir):
    return pr.outlier_report(activity(spark, sf_dir), NUM, 3.0)


@register("num_classes", CLEAN_CTE
          + f"SELECT CAST(count(*) AS BIGINT) AS num_classes FROM (SELECT DISTINCT {LAB} FROM strict)")
def q_num_classes(spark, sf_dir):
    return pr.num_classes(strict(spark, sf_dir), LAB)


# ---------------------------------------------------------------- B: cleaning
@register("clean_loose", CLEAN_CTE + "SELECT * FROM loose")
def q_clean_loose(spark, sf_dir):
    return loose(spark, sf_dir)


@register("clean_strict", CLEAN_CTE + "SELECT * FROM strict")
def q_clean_strict(spark, sf_dir):
    return strict(spark, sf_dir)


@register("class_filter", CTE + f"SELECT * FROM activity WHERE {LAB} = 'Yoga'")
def q_class_filter(spark, sf_dir):
    return cl.filter_class(activity(spark, sf_dir), LAB, "Yoga")


def _report_sql(where: str, relative_to: str) -> str:
    complete = " AND ".join(f"{c} IS NOT NULL" for c in ACTIVITY_COLS)
    den2 = "after_dropna" if relative_to == "step" else "initial_count"
    return CTE + f"""
, r AS (SELECT CAST(count(*) AS BIGINT) AS initial_count,
               CAST(count(*) FILTER (WHERE {complete}) AS BIGINT) AS after_dropna,
               CAST(count(*) FILTER (WHERE {complete} AND {where}) AS BIGINT) AS final_count FROM activity)
SELECT initial_count, after_dropna, final_count,
       CAST(initial_count - after_dropna AS DOUBLE) / NULLIF(initial_count, 0) * 100 AS dropna_removed_pct,
       CAST(after_dropna - final_count AS DOUBLE) / NULLIF({den2}, 0) * 100 AS filter_removed_pct,
       CAST(initial_count - final_count AS DOUBLE) / NULLIF(initial_count, 0) * 100 AS total_removed_pct FROM r"""


@register("cleaning_report_loose", _report_sql(LOOSE_WHERE, "step"))
def q_cleaning_report_loose(spark, sf_dir):
    return cl.cleaning_report(activity(spark, sf_dir), cl.LOOSE_RULES, relative_to="step")


@register("cleaning_report_strict", _report_sql(STRICT_WHERE, "initial"))
def q_cleaning_report_strict(spark, sf_dir):
    return cl.cleaning_report(activity(spark, sf_dir), cl.STRICT_RULES, relative_to="initial")


@register("null_profile", CTE + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count,"
    f" CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / NULLIF(count(*), 0) * 100 AS null_pct FROM activity"
    for c in ACTIVITY_COLS))
def q_null_profile(spark, sf_dir):
    return cl.null_profile(activity(spark, sf_dir))


# ---------------------------------------------------------------- B: features
# The oracles state the rules themselves, not the library's tables, so that an error in these can't cancel out.
_RATIO_SQL = {
    "calories_per_step": "CAST(Calories_Burned AS DOUBLE) / NULLIF(CAST(Steps AS DOUBLE) + 1, 0)",
    "intensity_score": "CAST(Heart_Rate_avg AS DOUBLE) * CAST(Calories_Burned AS DOUBLE) / NULLIF(CAST(Steps AS DOUBLE) + 1, 0)",
    "calorie_efficiency": "CAST(Calories_Burned AS DOUBLE) / NULLIF(CAST(Heart_Rate_avg AS DOUBLE) + 1, 0)",
    "steps_to_hr_ratio": "CAST(Steps AS DOUBLE) / NULLIF(CAST(Heart_Rate_avg AS DOUBLE) + 1, 0)",
    "cal_to_steps_ratio": "CAST(Calories_Burned AS DOUBLE) / NULLIF(CAST(Steps AS DOUBLE) + 1, 0)",
}


def _ratio_sql(name: str) -> str:
    return f"{_RATIO_SQL[name]} AS {name}"


def _bucket_sql(col: str, bounds, labels, out: str) -> str:
    whens = " ".join(f"WHEN {col} < {b} THEN '{lab}'" for b, lab in zip(bounds, labels[:-1]))
    return f"CASE {whens} ELSE '{labels[-1]}' END AS {out}"


def _pattern_case(rename: dict | None = None) -> str:
    """The activity-pattern rule as SQL; ``rename`` maps its labels to class names."""
    name = (lambda label: rename[label]) if rename else (lambda label: label)
    return (f"CASE WHEN Steps > 10000 AND Heart_Rate_avg > 140 THEN '{name('High_Intensity_Cardio')}'"
            f" WHEN Steps < 5000 AND Heart_Rate_avg < 120 THEN '{name('Low_Intensity')}'"
            f" WHEN Steps < 8000 AND Heart_Rate_avg > 130 THEN '{name('Strength_Like')}'"
            f" ELSE '{name('Moderate_Activity')}' END")


def _pattern_sql() -> str:
    return _pattern_case() + " AS activity_pattern"


def _features_v2_sql() -> str:
    from ..functions import expressions as ex
    cols = [_ratio_sql(n) for n in ["calories_per_step", "intensity_score", "calorie_efficiency"]]
    cols.append(_bucket_sql("Heart_Rate_avg", ex.HR_ZONE_BOUNDS, ex.HR_ZONE_LABELS, "hr_zone"))
    cols.append(_bucket_sql("Steps", ex.STEPS_CATEGORY_BOUNDS, ex.STEPS_CATEGORY_LABELS, "steps_category"))
    return CLEAN_CTE + "SELECT *, " + ", ".join(cols) + " FROM loose"


@register("features_v2", _features_v2_sql())
def q_features_v2(spark, sf_dir):
    return fe.create_features(loose(spark, sf_dir), "v2")


def _features_v3_sql() -> str:
    from ..functions import expressions as ex
    z = {c: f"({d(c)} - s.{c}_mean) / NULLIF(s.{c}_std + 0.001, 0)" for c in NUM}
    zn = {"Steps": "steps_normalized", "Heart_Rate_avg": "hr_normalized", "Calories_Burned": "cal_normalized"}
    cols = [_ratio_sql(n) for n in ["calories_per_step", "intensity_score", "calorie_efficiency"]]
    cols.append(_bucket_sql("Heart_Rate_avg", ex.HR_ZONE_DETAILED_BOUNDS, ex.HR_ZONE_DETAILED_LABELS,
                            "hr_zone_detailed"))
    cols.append(_pattern_sql())
    cols += [f"{z[c]} AS {zn[c]}" for c in NUM]
    stats = ", ".join(f"avg({d(c)}) AS {c}_mean, stddev_samp({d(c)}) AS {c}_std" for c in NUM)
    inner = "SELECT t.*, " + ", ".join(cols) + f" FROM tagged t, (SELECT {stats} FROM tagged WHERE split = 'train') s"
    outer = ("SELECT *, steps_normalized * hr_normalized AS steps_hr_interaction, "
             "steps_normalized * cal_normalized AS steps_cal_interaction, "
             "hr_normalized * cal_normalized AS hr_cal_interaction, "
             "pow(steps_normalized, 2) AS steps_squared, pow(hr_normalized, 2) AS hr_squared, "
             + _ratio_sql("steps_to_hr_ratio") + ", " + _ratio_sql("cal_to_steps_ratio") + f" FROM ({inner}) x")
    tagged = f"SELECT *, CASE WHEN {hash01_sql_duckdb('row_id')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM strict"
    return CLEAN_CTE.rstrip() + f",\ntagged AS ({tagged})\n" + outer


@register("features_v3", _features_v3_sql())
def q_features_v3(spark, sf_dir):
    """Both splits, with the statistics of the training split."""
    tagged = sa.split_column(strict(spark, sf_dir), "row_id", 0.8, 42)
    return fe.create_features(tagged, "v3", fe.fit_zscore(tagged.where("split = 'train'")))


# ---------------------------------------------------------------- F: split and rebalancing
HASH = hash01_sql_duckdb("row_id")
BALANCE_HASH = hash01_sql_duckdb("s.row_id", purpose="balance")


@register("train_test_split",
          CTE + f"SELECT *, CASE WHEN {HASH} < 0.8 THEN 'train' ELSE 'test' END AS split FROM activity")
def q_train_test_split(spark, sf_dir):
    return sa.split_column(activity(spark, sf_dir), "row_id", 0.8, 42)


_COUNTS = f", counts AS (SELECT {LAB}, count(*) AS n FROM strict WHERE {LAB} IS NOT NULL GROUP BY {LAB})\n"


@register("undersample", CLEAN_CTE + _COUNTS + f"""
, fr AS (SELECT {LAB}, CAST((SELECT min(n) FROM counts) AS DOUBLE) / CAST(n AS DOUBLE) AS f FROM counts)
SELECT s.* FROM strict s JOIN fr USING ({LAB}) WHERE {BALANCE_HASH} < fr.f""")
def q_undersample(spark, sf_dir):
    return sa.undersample(strict(spark, sf_dir), LAB, "row_id", 42)


@register("oversample", CLEAN_CTE + _COUNTS + f"""
, rt AS (SELECT {LAB}, CAST((SELECT max(n) FROM counts) AS DOUBLE) / CAST(n AS DOUBLE) AS r FROM counts)
, j AS (SELECT s.*, CAST(floor(rt.r) + CASE WHEN {BALANCE_HASH} < rt.r - floor(rt.r) THEN 1 ELSE 0 END
               AS BIGINT) AS copies FROM strict s JOIN rt USING ({LAB}))
SELECT * EXCLUDE (copies), unnest(generate_series(1, copies)) AS copy_id FROM j""")
def q_oversample(spark, sf_dir):
    return sa.oversample(strict(spark, sf_dir), LAB, "row_id", 42)


_TRAIN_COUNTS = f"""
, train AS (SELECT * FROM strict WHERE {HASH} < 0.8)
, counts AS (SELECT {LAB}, CAST(count(*) AS DOUBLE) AS n FROM train GROUP BY {LAB})
, lim AS (SELECT min(n) AS lo, max(n) AS hi FROM counts)
"""


def _strict_train(spark, sf_dir):
    return sa.train_test_split(strict(spark, sf_dir), "row_id", 0.8, 42)[0]


@register("balance_after_split_under", CLEAN_CTE + _TRAIN_COUNTS + f"""
SELECT s.row_id, s.{LAB} FROM train s JOIN counts USING ({LAB}), lim WHERE {BALANCE_HASH} < lo / n""")
def q_balance_after_split_under(spark, sf_dir):
    return sa.balance(_strict_train(spark, sf_dir), LAB, "undersample").select("row_id", LAB)


@register("balance_after_split_over", CLEAN_CTE + _TRAIN_COUNTS + f"""
, c AS (SELECT s.row_id, s.{LAB}, CAST(floor(hi / n) + CASE WHEN {BALANCE_HASH} < hi / n - floor(hi / n) THEN 1 ELSE 0 END
        AS BIGINT) AS copies FROM train s JOIN counts USING ({LAB}), lim)
SELECT row_id, {LAB}, unnest(generate_series(1, copies)) AS copy_id FROM c""")
def q_balance_after_split_over(spark, sf_dir):
    return sa.balance(_strict_train(spark, sf_dir), LAB, "oversample").select("row_id", LAB, "copy_id")


# ---------------------------------------------------------------- L: distribution tests
# The class list and its order, as the reference compares them.
REF_CLASSES = ["Cardio", "Strength", "Yoga", "None"]
PAIRS = [(a, b) for i, a in enumerate(REF_CLASSES) for b in REF_CLASSES[i + 1:]]


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


_SIDES = [(f"{a} vs {b}", c, s) for a, b in PAIRS for c, s in ((a, 0), (b, 1))]
_GRID = [(f"{a} vs {b}", c) for a, b in PAIRS for c in NUM]
LONG_CTE = CTE.rstrip() + f"""
, sides AS (SELECT * FROM (VALUES {_values(_SIDES)}) t(Comparison, cls, side))
, grid AS (SELECT * FROM (VALUES {_values(_GRID)}) t(Comparison, "Column"))
, long AS ({" UNION ALL ".join(
    f"SELECT {LAB} AS cls, '{c}' AS \"Column\", {d(c)} AS v FROM activity WHERE {c} IS NOT NULL AND {LAB} IS NOT NULL"
    for c in NUM)})
"""

KS_SQL = LONG_CTE + """
, tagged AS (SELECT l."Column", s.Comparison, l.v, CASE WHEN s.side = 0 THEN 1 ELSE 0 END AS na,
                    CASE WHEN s.side = 1 THEN 1 ELSE 0 END AS nb FROM long l JOIN sides s ON l.cls = s.cls)
, agg AS (SELECT "Column", Comparison, v, sum(na) AS na, sum(nb) AS nb FROM tagged GROUP BY ALL)
, cum AS (SELECT "Column", Comparison, v, sum(na) OVER w AS ca, sum(nb) OVER w AS cb FROM agg
          WINDOW w AS (PARTITION BY "Column", Comparison ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, tot AS (SELECT "Column", Comparison, sum(na) AS n1, sum(nb) AS n2 FROM tagged GROUP BY ALL)
, gaps AS (SELECT c."Column", c.Comparison, t.n1, t.n2,
                  max(abs(CAST(c.ca AS DOUBLE) / NULLIF(CAST(t.n1 AS DOUBLE), 0)
                          - CAST(c.cb AS DOUBLE) / NULLIF(CAST(t.n2 AS DOUBLE), 0))) AS KS_statistic
           FROM cum c JOIN tot t ON c."Column" = t."Column" AND c.Comparison = t.Comparison GROUP BY ALL)
, res AS (SELECT g.Comparison, g."Column", x.KS_statistic, x.n1, x.n2 FROM grid g
          LEFT JOIN gaps x ON g."Column" = x."Column" AND g.Comparison = x.Comparison)
, en AS (SELECT *, CAST(n1 AS DOUBLE) * CAST(n2 AS DOUBLE) / CAST(n1 + n2 AS DOUBLE) AS e FROM res)
, lam AS (SELECT *, (sqrt(e) + 0.12 + 0.11 / sqrt(e)) * KS_statistic AS lam FROM en)
, ser AS (SELECT Comparison, "Column",
                 sum(CASE WHEN r.k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * CAST(r.k AS DOUBLE) * CAST(r.k AS DOUBLE)
                     * lam * lam)) AS s
          FROM lam, (SELECT range AS k FROM range(1, 101)) r GROUP BY ALL)
SELECT l.Comparison, l."Column", l.KS_statistic,
       CAST(CASE WHEN l.KS_statistic IS NULL THEN NULL WHEN l.lam < 0.2 THEN 1.0
            ELSE least(greatest(2.0 * s.s, 0.0), 1.0) END AS DOUBLE) AS p_value,
       CAST(coalesce(l.n1, 0) AS BIGINT) AS n1, CAST(coalesce(l.n2, 0) AS BIGINT) AS n2
FROM lam l JOIN ser s ON l.Comparison = s.Comparison AND l."Column" = s."Column"
"""


@register("ks_two_sample", KS_SQL)
def q_ks_two_sample(spark, sf_dir):
    return di.ks_two_sample(activity(spark, sf_dir), NUM, LAB, REF_CLASSES)


JSD_SQL = LONG_CTE + """
, ranges AS (SELECT "Column", cls, min(v) AS vmin, max(v) AS vmax, count(*) AS n FROM long GROUP BY ALL)
, bounds AS (SELECT s.Comparison, r."Column", min(vmin) AS lo, max(vmax) AS hi,
                    sum(CASE WHEN s.side = 0 THEN n END) AS n1, sum(CASE WHEN s.side = 1 THEN n END) AS n2
             FROM sides s JOIN ranges r ON s.cls = r.cls GROUP BY ALL)
, b2 AS (SELECT *, (hi - lo) / 30.0 AS step FROM bounds)
, tagged AS (SELECT l."Column", s.Comparison, s.side, l.v, b.lo, b.step FROM long l JOIN sides s ON l.cls = s.cls
             JOIN b2 b ON b.Comparison = s.Comparison AND b."Column" = l."Column" WHERE b.step > 0)
, guessed AS (SELECT *, CAST(least(greatest(floor((v - lo) / step), 0), 29) AS INTEGER) AS g FROM tagged)
, fixed AS (SELECT *, CASE WHEN v < CAST(g AS DOUBLE) * step + lo THEN g - 1
                           WHEN g < 29 AND v >= CAST(g + 1 AS DOUBLE) * step + lo THEN g + 1 ELSE g END AS bin
            FROM guessed)
, counts AS (SELECT Comparison, "Column", bin, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c1,
                    sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c2 FROM fixed GROUP BY ALL)
, dense AS (SELECT b.Comparison, b."Column", b.n1, b.n2, b.lo, b.hi, b.step, r.bin,
                   CAST(coalesce(c.c1, 0) AS DOUBLE) AS c1, CAST(coalesce(c.c2, 0) AS DOUBLE) AS c2
            FROM b2 b CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 30)) r
            LEFT JOIN counts c ON c.Comparison = b.Comparison AND c."Column" = b."Column" AND c.bin = r.bin
            WHERE b.step > 0)
, widths AS (SELECT *, CASE WHEN bin = 29 THEN hi ELSE CAST(bin + 1 AS DOUBLE) * step + lo END
                       - (CAST(bin AS DOUBLE) * step + lo) AS w FROM dense)
, dens AS (SELECT Comparison, "Column", bin, c1 / w / CAST(n1 AS DOUBLE) + 1e-12 AS d1,
                  c2 / w / CAST(n2 AS DOUBLE) + 1e-12 AS d2 FROM widths)
, sums AS (SELECT Comparison, "Column", sum(d1) AS s1, sum(d2) AS s2 FROM dens GROUP BY ALL)
, pq AS (SELECT d.Comparison, d."Column", d1 / s1 AS p, d2 / s2 AS q FROM dens d
         JOIN sums s ON d.Comparison = s.Comparison AND d."Column" = s."Column")
, jsd AS (SELECT Comparison, "Column",
                 sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / (2.0 * ln(2.0)) AS j
          FROM pq GROUP BY ALL)
, res AS (SELECT g.Comparison, g."Column",
                 CASE WHEN b.n1 IS NULL OR b.n2 IS NULL THEN NULL WHEN b.step = 0 THEN 0.0 ELSE j.j END AS JSD
          FROM grid g LEFT JOIN b2 b ON g.Comparison = b.Comparison AND g."Column" = b."Column"
          LEFT JOIN jsd j ON g.Comparison = j.Comparison AND g."Column" = j."Column")
SELECT Comparison, "Column", CAST(JSD AS DOUBLE) AS JSD,
       CASE WHEN JSD IS NULL THEN NULL WHEN JSD < 0.05 THEN 'Very similar' WHEN JSD < 0.2 THEN 'Somewhat different'
            ELSE 'Noticeably different' END AS Divergence FROM res
"""


@register("jensen_shannon", JSD_SQL)
def q_jensen_shannon(spark, sf_dir):
    return di.jensen_shannon(activity(spark, sf_dir), NUM, LAB, REF_CLASSES)


# Pairwise tests over every pair of some thousand classes: parts by the quantities of their line items.
def _many_sql(tail: str) -> str:
    return f"""
WITH q AS (SELECT l_partkey AS cls, l_quantity AS v, count(*) AS w FROM lineitem
           WHERE l_partkey IS NOT NULL AND l_quantity IS NOT NULL GROUP BY ALL)
, k AS (SELECT cls, min(v) AS lo, max(v) AS hi, sum(w) AS n FROM q GROUP BY cls)
{tail}
, either AS (SELECT a AS cls, x, p FROM pairs UNION ALL SELECT b, x, p FROM pairs)
"""


KS_MANY_SQL = _many_sql("""
, cdf AS (SELECT k.cls, x.v, k.n, CAST(sum(coalesce(q.w, 0)) OVER (PARTITION BY k.cls ORDER BY x.v) AS DOUBLE) / CAST(k.n AS DOUBLE) AS f
         FROM k CROSS JOIN (SELECT DISTINCT v FROM q) x LEFT JOIN q ON q.cls = k.cls AND q.v = x.v)
, gaps AS (SELECT l.cls AS a, r.cls AS b, max(abs(l.f - r.f)) AS x, CAST(any_value(l.n) AS DOUBLE) * CAST(any_value(r.n) AS DOUBLE)
                  / CAST(any_value(l.n) + any_value(r.n) AS DOUBLE) AS e
           FROM cdf l JOIN cdf r ON l.v = r.v AND l.cls < r.cls GROUP BY ALL)
, lam AS (SELECT *, (sqrt(e) + 0.12 + 0.11 / sqrt(e)) * x AS lam FROM gaps)
, pairs AS (SELECT a, b, x, CASE WHEN lam < 0.2 THEN 1.0 ELSE 2.0 * (""" + " ".join(
    f"{'+' if k % 2 else '-'} exp({-2.0 * k * k} * lam * lam)" for k in range(1, 21)) + """) END AS p FROM lam)""") + """
SELECT 'l_quantity' AS "Column", cls AS "class", CAST(count(*) AS BIGINT) AS n_pairs,
       CAST(count(*) FILTER (WHERE p < 0.05) AS BIGINT) AS n_different, max(x) AS max_ks FROM either GROUP BY cls"""


@register("ks_many_classes", KS_MANY_SQL)
def q_ks_many_classes(spark, sf_dir):
    return di.ks_by_class(read_table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_partkey")


JSD_MANY_SQL = _many_sql("""
, ab AS (SELECT l.cls AS a, r.cls AS b, least(l.lo, r.lo) AS lo, greatest(l.hi, r.hi) AS hi, l.n AS n1, r.n AS n2,
                (greatest(l.hi, r.hi) - least(l.lo, r.lo)) / 30.0 AS step FROM k l JOIN k r ON l.cls < r.cls)
, tagged AS (SELECT a, b, lo, hi, n1, n2, step, v, w, 0 AS z FROM ab JOIN q ON q.cls = a WHERE step > 0
             UNION ALL SELECT a, b, lo, hi, n1, n2, step, v, 0, w FROM ab JOIN q ON q.cls = b WHERE step > 0)
, g AS (SELECT *, CAST(least(greatest(floor((v - lo) / step), 0), 29) AS INTEGER) AS g FROM tagged)
, bins AS (SELECT a, b, lo, hi, n1, n2, step, CASE WHEN v < CAST(g AS DOUBLE) * step + lo THEN g - 1
                  WHEN g < 29 AND v >= CAST(g + 1 AS DOUBLE) * step + lo THEN g + 1 ELSE g END AS bin, sum(w) AS c1, sum(z) AS c2
           FROM g GROUP BY ALL)
, d AS (SELECT a, b, c1 / (CASE WHEN bin = 29 THEN hi ELSE CAST(bin + 1 AS DOUBLE) * step + lo END - (CAST(bin AS DOUBLE) * step + lo))
               / CAST(n1 AS DOUBLE) + 1e-12 AS d1,
               c2 / (CASE WHEN bin = 29 THEN hi ELSE CAST(bin + 1 AS DOUBLE) * step + lo END - (CAST(bin AS DOUBLE) * step + lo))
               / CAST(n2 AS DOUBLE) + 1e-12 AS d2 FROM bins)
, s AS (SELECT a, b, sum(d1) + (30 - count(*)) * 1e-12 AS s1, sum(d2) + (30 - count(*)) * 1e-12 AS s2 FROM d GROUP BY ALL)
, pq AS (SELECT d.a, d.b, d1 / s1 AS p, d2 / s2 AS q FROM d JOIN s ON d.a = s.a AND d.b = s.b)
, j AS (SELECT a, b, sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / (2.0 * ln(2.0)) AS x FROM pq GROUP BY ALL)
, pairs AS (SELECT ab.a, ab.b, CASE WHEN step = 0 THEN 0.0 ELSE j.x END AS x, 0 AS p FROM ab LEFT JOIN j ON j.a = ab.a AND j.b = ab.b)""") + """
SELECT 'l_quantity' AS "Column", cls AS "class", CAST(count(*) AS BIGINT) AS n_pairs,
       CAST(count(*) FILTER (WHERE x >= 0.2) AS BIGINT) AS n_noticeable, CAST(max(x) AS DOUBLE) AS max_jsd FROM either GROUP BY cls"""


@register("jensen_shannon_many_classes", JSD_MANY_SQL)
def q_jensen_shannon_many_classes(spark, sf_dir):
    return di.jensen_shannon_by_class(read_table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_partkey")


KDE_SQL = LONG_CTE + """
, stats AS (SELECT "Column", cls, count(*) AS n, stddev_samp(v) AS sd, min(v) AS vmin, max(v) AS vmax FROM long
            GROUP BY ALL HAVING count(*) >= 2 AND stddev_samp(v) > 0)
, s2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM stats)
, s3 AS (SELECT *, vmin - 3.0 * h AS lo, vmax + 3.0 * h AS hi FROM s2)
, s4 AS (SELECT *, (hi - lo) / 199.0 AS step FROM s3)
, g AS (SELECT "Column", cls, n, h, CAST(p.range AS INTEGER) AS point,
               CASE WHEN p.range = 199 THEN hi ELSE CAST(p.range AS DOUBLE) * step + lo END AS x
        FROM s4, range(0, 200) p)
, pts AS (SELECT "Column", cls, v, count(*) AS w FROM long GROUP BY ALL)
SELECT g."Column", g.cls AS class, g.point, g.x,
       sum(CAST(p.w AS DOUBLE) * exp(-0.5 * ((g.x - p.v) / g.h) * ((g.x - p.v) / g.h)))
       / (CAST(g.n AS DOUBLE) * g.h * sqrt(2.0 * pi())) AS density
FROM g JOIN pts p ON g."Column" = p."Column" AND g.cls = p.cls
GROUP BY g."Column", g.cls, g.point, g.x, g.n, g.h
"""


@register("kde_curves", KDE_SQL)
def q_kde_curves(spark, sf_dir):
    return di.kde_curves(activity(spark, sf_dir), NUM, LAB)


def _chi_cte(table: str, a: str, b: str) -> str:
    """Cells of the full table, unobserved ones included."""
    return f"""
WITH obs AS (SELECT {a} AS a, {b} AS b, CAST(count(*) AS DOUBLE) AS o FROM {table}
             WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL)
, ra AS (SELECT a, sum(o) AS ra FROM obs GROUP BY a)
, cb AS (SELECT b, sum(o) AS cb FROM obs GROUP BY b)
, nn AS (SELECT sum(o) AS n FROM obs)
, st AS (SELECT CAST(max(n) AS BIGINT) AS n, (SELECT count(*) FROM ra) AS levels_a, (SELECT count(*) FROM cb) AS levels_b,
                CAST(((SELECT count(*) FROM ra) - 1) * ((SELECT count(*) FROM cb) - 1) AS BIGINT) AS dof,
                sum((coalesce(o, 0) - ra * cb / n) * (coalesce(o, 0) - ra * cb / n) / (ra * cb / n)) AS statistic
         FROM ra CROSS JOIN cb CROSS JOIN nn LEFT JOIN obs ON obs.a = ra.a AND obs.b = cb.b)
"""


@register("chi_square_statistic", _chi_cte("orders", "o_orderstatus", "o_orderpriority") + "SELECT * FROM st")
def q_chi_square_statistic(spark, sf_dir):
    return di.chi_square_statistic(read_table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@register("chi_square_many_levels", _chi_cte("events", "user_id", "event_type") + "SELECT * FROM st")
def q_chi_square_many_levels(spark, sf_dir):
    """A user against an event type: as many levels as users."""
    return di.chi_square_statistic(read_table(spark, sf_dir, "events"), "user_id", "event_type")


CHI_TEST_SQL = _chi_cte("orders", "o_orderstatus", "o_orderpriority") + """
, ser AS (SELECT sum(exp(-(statistic / 2.0) + (dof / 2.0 + r.k) * ln(statistic / 2.0) - lgamma(dof / 2.0 + r.k + 1)))
                 AS lower FROM st, (SELECT range AS k FROM range(0, 5000)) r WHERE statistic > 0)
SELECT n, levels_a, levels_b, dof, statistic,
       CAST(CASE WHEN dof <= 0 THEN NULL WHEN statistic <= 0 THEN 1.0
                 ELSE greatest(0.0, 1.0 - (SELECT lower FROM ser)) END AS DOUBLE) AS p_value
FROM st
"""


@register("chi_square_test", CHI_TEST_SQL)
def q_chi_square_test(spark, sf_dir):
    return di.chi_square_test(read_table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


def _ks_normality_sql() -> str:
    from ..functions.stats import normal_cdf_sql
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {d(c)} AS v FROM activity WHERE {c} IS NOT NULL" for c in NUM)
    cdf = normal_cdf_sql("((v - mean) / std)")
    return CTE.rstrip() + f"""
, long AS ({long})
, mom AS (SELECT "column", count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std FROM long GROUP BY ALL)
, g AS (SELECT "column", v, count(*) AS w FROM long GROUP BY ALL)
, c AS (SELECT "column", v, CAST(w AS DOUBLE) AS w,
               CAST(sum(w) OVER (PARTITION BY "column" ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                    AS DOUBLE) AS cw FROM g)
, f AS (SELECT c."column", c.v, c.w, c.cw, CAST(m.n AS DOUBLE) AS n, m.mean, m.std FROM c
        JOIN mom m ON c."column" = m."column" WHERE m.std > 0)
, cdf AS (SELECT *, {cdf} AS fv FROM f)
, st AS (SELECT "column", max(greatest(cw / n - fv, fv - (cw - w) / n)) AS ks_statistic FROM cdf GROUP BY ALL)
, r AS (SELECT m."column", m.n, m.mean, m.std, s.ks_statistic,
               (sqrt(CAST(m.n AS DOUBLE)) + 0.12 + 0.11 / sqrt(CAST(m.n AS DOUBLE))) * s.ks_statistic AS lam
        FROM mom m LEFT JOIN st s ON m."column" = s."column")
, ser AS (SELECT "column", sum(CASE WHEN r2.k % 2 = 1 THEN 1.0 ELSE -1.0 END
                               * exp(-2.0 * CAST(r2.k AS DOUBLE) * CAST(r2.k AS DOUBLE) * lam * lam)) AS s
          FROM r, (SELECT range AS k FROM range(1, 101)) r2 GROUP BY ALL)
, pv AS (SELECT r.*, CAST(CASE WHEN r.ks_statistic IS NULL THEN NULL WHEN r.lam < 0.2 THEN 1.0
                          ELSE least(greatest(2.0 * ser.s, 0.0), 1.0) END AS DOUBLE) AS p_value
         FROM r JOIN ser ON r."column" = ser."column")
SELECT "column", CAST(n AS BIGINT) AS n, mean, std, ks_statistic, p_value,
       CASE WHEN p_value IS NULL THEN NULL WHEN p_value < 0.05 THEN 'NOT normally distributed'
            ELSE 'looks normal-ish' END AS verdict FROM pv"""


@register("ks_normality", _ks_normality_sql())
def q_ks_normality(spark, sf_dir):
    return di.ks_normality(activity(spark, sf_dir), NUM)


# ---------------------------------------------------------------- K, H, I: evaluation against a rule predictor
RULE_SQL = _pattern_case(ex.PATTERN_CLASS)
PRED_CTE = CLEAN_CTE.rstrip() + f"""
, p AS (SELECT *, {RULE_SQL} AS predicted, CASE WHEN {HASH} < 0.8 THEN 'train' ELSE 'test' END AS split FROM strict)
"""


def rule_predictions(spark, sf_dir):
    return sa.split_column(strict(spark, sf_dir), "row_id").withColumn("predicted", ex.rule_class())


def _per_class_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    on = f"a.{group} = b.{group} AND " if group else ""
    gsel = f"coalesce(a.{group}, b.{group}) AS {group}, " if group else ""
    return f"""
, counts AS (SELECT {g}{LAB} AS actual, predicted, count(*) AS cnt FROM p GROUP BY ALL)
, act AS (SELECT {g}actual AS class, sum(cnt) AS support,
                 sum(CASE WHEN actual = predicted THEN cnt ELSE 0 END) AS tp FROM counts GROUP BY ALL)
, prd AS (SELECT {g}predicted AS class, sum(cnt) AS predicted_n FROM counts GROUP BY ALL)
, pc AS (SELECT {gsel}coalesce(a.class, b.class) AS class, CAST(coalesce(a.support, 0) AS DOUBLE) AS support,
                CAST(coalesce(a.tp, 0) AS DOUBLE) AS tp, CAST(coalesce(b.predicted_n, 0) AS DOUBLE) AS predicted_n
         FROM act a FULL OUTER JOIN prd b ON {on}a.class = b.class)
, pr AS (SELECT *, coalesce(tp / NULLIF(predicted_n, 0), 0.0) AS precision,
                   coalesce(tp / NULLIF(support, 0), 0.0) AS recall FROM pc)
, sc AS (SELECT *, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM pr)
"""


@register("rule_per_class_metrics", PRED_CTE + _per_class_sql(None) +
          "SELECT class, precision, recall, f1, CAST(support AS BIGINT) AS support FROM sc")
def q_rule_per_class_metrics(spark, sf_dir):
    return ev.per_class_metrics(rule_predictions(spark, sf_dir), LAB, "predicted")


@register("rule_metrics_by_split", PRED_CTE + _per_class_sql("split") + """
SELECT split, CAST(sum(support) AS BIGINT) AS n, sum(recall * support) / NULLIF(sum(support), 0) AS accuracy,
       sum(f1 * support) / NULLIF(sum(support), 0) AS f1_score,
       sum(precision * support) / NULLIF(sum(support), 0) AS precision,
       sum(recall * support) / NULLIF(sum(support), 0) AS recall FROM sc GROUP BY split""")
def q_rule_metrics_by_split(spark, sf_dir):
    return ev.classification_metrics(rule_predictions(spark, sf_dir), LAB, "predicted", ["split"])


@register("rule_confusion_matrix", PRED_CTE + f"""
, cls AS (SELECT {LAB} AS c FROM p UNION SELECT predicted FROM p)
, counts AS (SELECT {LAB} AS actual, predicted, count(*) AS cnt FROM p GROUP BY ALL)
SELECT a.c AS actual, b.c AS predicted, CAST(coalesce(k.cnt, 0) AS BIGINT) AS count
FROM cls a CROSS JOIN cls b LEFT JOIN counts k ON k.actual = a.c AND k.predicted = b.c""")
def q_rule_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(rule_predictions(spark, sf_dir), LAB, "predicted")


@register("rule_overfitting_gap", PRED_CTE + f"""
, acc AS (SELECT split, avg(CASE WHEN {LAB} = predicted THEN 1.0 ELSE 0.0 END) AS a FROM p GROUP BY split)
, r AS (SELECT CAST(max(CASE WHEN split = 'train' THEN a END) AS DOUBLE) AS train_accuracy,
               CAST(max(CASE WHEN split = 'test' THEN a END) AS DOUBLE) AS test_accuracy FROM acc)
SELECT train_accuracy, test_accuracy, train_accuracy - test_accuracy AS gap,
       train_accuracy - test_accuracy > 0.15 AS overfitting,
       CASE WHEN test_accuracy IS NULL THEN NULL WHEN test_accuracy > 0.8 THEN 'EXCELLENT'
            WHEN test_accuracy > 0.6 THEN 'GOOD' WHEN test_accuracy > 0.4 THEN 'MODERATE' ELSE 'POOR' END AS verdict
FROM r""")
def q_rule_overfitting_gap(spark, sf_dir):
    return ev.overfitting_gap(rule_predictions(spark, sf_dir), "split", LAB, "predicted")


@register("rule_prediction_sample", PRED_CTE + f"""
SELECT row_id, Steps, Heart_Rate_avg, Calories_Burned, {LAB}, predicted FROM p ORDER BY row_id LIMIT 20""")
def q_rule_prediction_sample(spark, sf_dir):
    return ev.prediction_sample(rule_predictions(spark, sf_dir), "row_id", [*NUM, LAB, "predicted"], 20)


@register("accuracy_by_counting", PRED_CTE +
          f"SELECT avg(CASE WHEN {LAB} = predicted THEN 1.0 ELSE 0.0 END) AS accuracy FROM p")
def q_accuracy_by_counting(spark, sf_dir):
    return ev.accuracy_by_counting(rule_predictions(spark, sf_dir), LAB, "predicted")


@register("auc_heart_rate", CTE + f"""
, b AS (SELECT CAST(Heart_Rate_avg AS DOUBLE) AS s, CASE WHEN {LAB} = 'Cardio' THEN 1 ELSE 0 END AS pos,
               CASE WHEN {LAB} = 'Cardio' THEN 0 ELSE 1 END AS neg
        FROM activity WHERE {LAB} IN ('Cardio', 'None') AND Heart_Rate_avg IS NOT NULL)
, g AS (SELECT s, sum(pos) AS pos, sum(neg) AS neg FROM b GROUP BY s)
, c AS (SELECT s, pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM g)
, t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM b)
SELECT (SELECT sum(CAST(pos AS DOUBLE) * (CAST(cn AS DOUBLE) - CAST(neg AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0)) FROM c)
       / (CAST(t.P AS DOUBLE) * CAST(t.N AS DOUBLE)) AS auc,
       CAST(t.P AS BIGINT) AS positives, CAST(t.N AS BIGINT) AS negatives FROM t""")
def q_auc_heart_rate(spark, sf_dir):
    from pyspark.sql import functions as F
    binary = activity(spark, sf_dir).where(F.col(LAB).isin("Cardio", "None"))
    scored = binary.select((F.col(LAB) == "Cardio").cast("double").alias("label"),
                           F.col("Heart_Rate_avg").alias("score"))
    return ev.auc_roc(scored, "label", "score", 1.0)


@register("linear_rule_regression_metrics", CLEAN_CTE + f"""
, p AS (SELECT CAST(Calories_Burned AS DOUBLE) AS y,
               50.0 + 0.01 * CAST(Steps AS DOUBLE) + 0.5 * CAST(Heart_Rate_avg AS DOUBLE) AS yhat FROM loose)
SELECT sqrt(sum((y - yhat) * (y - yhat)) / count(*)) AS RMSE,
       1.0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS R2,
       sum(abs(y - yhat)) / count(*) AS MAE FROM p""")
def q_linear_rule_regression_metrics(spark, sf_dir):
    return ev.regression_metrics(loose(spark, sf_dir).withColumn("prediction", ex.linear_rule()), "Calories_Burned")


@register("label_index_roundtrip", CTE + f"""
, c AS (SELECT {LAB}, count(*) AS n FROM activity WHERE {LAB} IS NOT NULL GROUP BY {LAB})
, r AS (SELECT {LAB}, CAST(row_number() OVER (ORDER BY n DESC, {LAB} ASC) - 1 AS DOUBLE) AS label FROM c)
SELECT a.row_id, a.{LAB}, r.label, a.{LAB} AS predicted_label FROM activity a JOIN r ON a.{LAB} = r.{LAB}""")
def q_label_index_roundtrip(spark, sf_dir):
    from ..plans import preprocessing as pp
    data = activity(spark, sf_dir)
    indexer = pp.label_indexer(LAB, "label", handle_invalid="skip").fit(data)
    indexed = indexer.transform(data)
    return ev.with_predicted_label(indexed, indexer.labels, "label").select("row_id", LAB, "label", "predicted_label")


# ---------------------------------------------------------------- A: table sources and sinks
_TYPES = {"row_id": "bigint", "Steps": "bigint", "Heart_Rate_avg": "double", "Calories_Burned": "double", LAB: "string"}


@register("describe_columns", CTE + " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, '{t}' AS data_type, count(*) AS n_rows, count({c}) AS n_values FROM activity"
    for c, t in _TYPES.items()))
def q_describe_columns(spark, sf_dir):
    """A3: columns with their types, joined to what a pass over the rows finds in them."""
    from pyspark.sql import functions as F

    from ..sources.tables import describe_columns
    data = activity(spark, sf_dir)
    nulls = cl.null_profile(data).select(F.col("column").alias("col_name"), "null_count")
    total = data.agg(F.count(F.lit(1)).alias("n_rows"))
    return pr.with_scalars(describe_columns(data).join(nulls, "col_name"), total).select(
        "col_name", "data_type", "n_rows", (F.col("n_rows") - F.col("null_count")).alias("n_values"))


LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_TEXT = ["l_returnflag", "l_linestatus"]


@register("wide_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, avg({d(c)}) AS mean, stddev_samp({d(c)}) AS stddev,"
    f" min({d(c)}) AS min, max({d(c)}) AS max FROM lineitem" for c in LINE_NUM))
def q_wide_profile(spark, sf_dir):
    """C8 over a wider and larger table (FIXTURES F2)."""
    return pr.describe_numeric(read_table(spark, sf_dir, "lineitem"), LINE_NUM)


@register("describe_strings", " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, min({c}) AS min, max({c}) AS max FROM lineitem"
    for c in LINE_TEXT))
def q_describe_strings(spark, sf_dir):
    return pr.describe_strings(read_table(spark, sf_dir, "lineitem"), LINE_TEXT)


UPSERT_SQL = CTE.rstrip() + f"""
, target AS (SELECT * FROM activity WHERE {HASH} < 0.7)
, source AS (SELECT row_id, Steps, Heart_Rate_avg, Calories_Burned + 1.0 AS Calories_Burned, {LAB}
             FROM activity WHERE {HASH} >= 0.5)
SELECT * FROM target WHERE row_id NOT IN (SELECT row_id FROM source) UNION ALL SELECT * FROM source
"""


@register("upsert", UPSERT_SQL)
def q_upsert(spark, sf_dir):
    from pyspark.sql import functions as F

    from ..functions.hashing import hash01
    from ..sources.tables import upsert, with_changed
    data = activity(spark, sf_dir)
    target = data.where(hash01("row_id") < 0.7)
    source = with_changed(data.where(hash01("row_id") >= 0.5), "Calories_Burned", 1.0).select(*data.columns)
    return upsert(target, source, ["row_id"]).select(*[F.col(c) for c in data.columns])


@register("upsert_in_place", UPSERT_SQL)
def q_upsert_in_place(spark, sf_dir):
    """A9 on a stored table: its rows after the upsert has rewritten the buckets of the source's keys."""
    import uuid

    from ..functions.hashing import hash01
    from ..session import ensure_checkpoint_dir
    from ..sources import tables as ta
    from pyspark.sql import functions as F
    data = activity(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/upsert-{uuid.uuid4().hex}"
    ta.create_keyed_table(data.where(hash01("row_id") < 0.7), path, ["row_id"], buckets=16)
    ta.upsert_table(spark, path, ta.with_changed(data.where(hash01("row_id") >= 0.5), "Calories_Burned", 1.0))
    return ta.read_keyed_table(spark, path).select(*data.columns)


# ---------------------------------------------------------------- J: trained models (no SQL form: rows-only checks)
def _ml_input(spark, sf_dir):
    return activity(spark, sf_dir)


@register("logistic_regression_accuracy")
def q_logistic_regression_accuracy(spark, sf_dir):
    """J1 + C17: one-feature logistic regression of the class on calories, accuracy on the test split."""
    from pyspark.ml import Pipeline

    from . import estimators as es
    from .preprocessing import preprocessing_stages
    data = cl.drop_nulls(activity(spark, sf_dir), [LAB, "Calories_Burned"])
    train, test = sa.train_test_split(data, "row_id")
    model = Pipeline(stages=[*preprocessing_stages(["Calories_Burned"], target_col=LAB, scaler=None),
                             es.logistic_regression()]).fit(train)
    return ev.accuracy_by_counting(model.transform(test))


@register("rf_regression_residuals")
def q_rf_regression_residuals(spark, sf_dir):
    """J4 + I2 + B16: forest regression of calories, every cleaned row scored, with ``Diff``."""
    from .training import train_regressor
    _, scored, _ = train_regressor(activity(spark, sf_dir), "rf", one_hot=True, score_all=True)
    return scored.select("row_id", "Steps", "Heart_Rate_avg", LAB, "Calories_Burned", "prediction", "Diff")


@register("linear_regression_metrics")
def q_linear_regression_metrics(spark, sf_dir):
    """J3 + K3: linear regression of calories, RMSE / R2 / MAE on the test split."""
    from .training import train_regressor
    _, _, metrics = train_regressor(activity(spark, sf_dir), "linear", one_hot=False)
    return metrics


@register("rf_class_predictions")
def q_rf_class_predictions(spark, sf_dir):
    """J5 + H1 + K9: default forest on the loose-cleaned table, every row scored with its class name."""
    from pyspark.ml import Pipeline

    from . import estimators as es
    from .preprocessing import preprocessing_stages
    data = loose(spark, sf_dir)
    model = Pipeline(stages=[*preprocessing_stages(NUM, target_col=LAB, scaler=None), es.rf_classifier()]).fit(data)
    labels = list(model.stages[0].labels)
    return ev.with_predicted_label(model.transform(data), labels) \
        .select("row_id", *NUM, LAB, "prediction", "predicted_label")


@register("train_v1_metrics")
def q_train_v1_metrics(spark, sf_dir):
    """J15 v1 + K1 + K7: standard-scaled forest, metrics on both splits."""
    from .training import TrainConfig, train_classifier
    return train_classifier(activity(spark, sf_dir), TrainConfig(version="v1")).metrics


@register("train_v2_feature_importance")
def q_train_v2_feature_importance(spark, sf_dir):
    """J15 v2 + K8: forest on ratio and bucket features; importances ascending."""
    from .training import TrainConfig, train_classifier
    res = train_classifier(activity(spark, sf_dir), TrainConfig(version="v2"))
    return ev.feature_importance(res.model, res.feature_names)


@register("model_comparison_v3")
def q_model_comparison_v3(spark, sf_dir):
    """J12 + J13 on v3 features (strict cleaning, undersampled train): one metrics row per model."""
    from .training import TrainConfig, train_classifier
    cfg = TrainConfig(version="v3", rules=dict(cl.STRICT_RULES), balance="undersample", compare=True)
    return train_classifier(activity(spark, sf_dir), cfg).comparison


def _tuned(spark, sf_dir):
    from .preprocessing import preprocessing_stages
    from .training import RF_GRID, TrainConfig, cross_validate, prepare_splits
    train, _ = prepare_splits(activity(spark, sf_dir), TrainConfig(version="v1"))
    return cross_validate(train, preprocessing_stages(NUM, target_col=LAB), RF_GRID)


@register("tune_forest_grid")
def q_tune_forest_grid(spark, sf_dir):
    """The cross-validated grid (8 combinations, 3 folds) on the v1 training split; mean metric per combination."""
    return _tuned(spark, sf_dir).means()


def _checks(name: str, df, **conditions):
    """One row: the rows, and how many of them break each condition."""
    from pyspark.sql import functions as F
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()])


@register("rf_class_predictions_check", CLEAN_CTE + "SELECT count(*) AS n_rows, 0 AS bad_label, 0 AS bad_index FROM loose")
def q_rf_class_predictions_check(spark, sf_dir):
    """Every cleaned row is scored; its class name is that of its index in the labels by frequency."""
    from pyspark.sql import functions as F
    out = q_rf_class_predictions(spark, sf_dir)
    counts = loose(spark, sf_dir).groupBy(LAB).agg(F.count(F.lit(1)).alias("n"))
    order = counts.agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), LAB))), lambda x: x[LAB]).alias("names"))
    named = pr.with_scalars(out, order)
    return _checks("rf", named, bad_label=F.col("predicted_label") == F.get("names", F.col("prediction").cast("int")),
                   bad_index=F.col("prediction").between(0, 3))


@register("rf_regression_residuals_check", CLEAN_CTE + """
SELECT count(*) AS n_rows, 0 AS bad_diff, 0 AS bad_range FROM loose""")
def q_rf_regression_residuals_check(spark, sf_dir):
    """Every cleaned row is scored; Diff is the residual, and a forest predicts within the range of its label."""
    from pyspark.sql import functions as F
    out = q_rf_regression_residuals(spark, sf_dir)
    span = loose(spark, sf_dir).agg(F.min("Calories_Burned").alias("lo"), F.max("Calories_Burned").alias("hi"))
    return _checks("rf", pr.with_scalars(out, span), bad_diff=F.abs(F.col("Calories_Burned") - F.col("prediction") - F.col("Diff")) < 1e-9,
                   bad_range=F.col("prediction").between(F.col("lo") - 1e-9, F.col("hi") + 1e-9))


@register("numeric_monitoring_approx_check", CTE + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS n, true AS within FROM activity" for c in NUM))
def q_numeric_monitoring_approx_check(spark, sf_dir):
    """The approximate median's rank differs from the exact one by no more than the sketch allows (n / accuracy)."""
    from pyspark.sql import functions as F
    data = activity(spark, sf_dir)
    row = pr.with_scalars(data.select(*NUM), q_numeric_monitoring_approx(spark, sf_dir).select(*[f"{c}_Median" for c in NUM]))
    aggs = [a for c in NUM for a in (F.count(c).alias(f"n_{c}"), F.count_if(F.col(c) < F.col(f"{c}_Median")).alias(f"b_{c}"),
                                     F.count_if(F.col(c) <= F.col(f"{c}_Median")).alias(f"u_{c}"))]
    slack = [F.col(f"n_{c}") / 10000 + 1 for c in NUM]
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"),
                        ((F.col(f"b_{c}") <= F.col(f"n_{c}") / 2 + s) & (F.col(f"u_{c}") >= F.col(f"n_{c}") / 2 - s)).alias("within"))
               for c, s in zip(NUM, slack, strict=True)]
    return row.agg(*aggs).select(F.inline(F.array(*structs)))


@register("logistic_accuracy_check", CTE + f"""
SELECT true AS same_as_evaluator, true AS beats_majority FROM (SELECT 1)""")
def q_logistic_accuracy_check(spark, sf_dir):
    """C17 against Spark's evaluator on the same test rows, and against predicting the most frequent class."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.sql import functions as F

    from . import estimators as es
    from .preprocessing import preprocessing_stages
    data = cl.drop_nulls(activity(spark, sf_dir), [LAB, "Calories_Burned"])
    train, test = sa.train_test_split(data, "row_id")
    model = Pipeline(stages=[*preprocessing_stages(["Calories_Burned"], target_col=LAB, scaler=None),
                             es.logistic_regression()]).fit(train)
    scored = model.transform(test)
    theirs = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored)
    ours = pr.with_scalars(ev.accuracy_by_counting(scored), scored.agg(F.avg((F.col("label") == 0).cast("double")).alias("major")))
    return ours.select((F.abs(F.col("accuracy") - F.lit(theirs)) < 1e-12).alias("same_as_evaluator"),
                       (F.col("accuracy") >= F.col("major") - 0.02).alias("beats_majority"))


# Normal equations of Calories on (1, Steps, Heart_Rate_avg, class index), solved by elimination on centred moments.
_LR_SQL = CLEAN_CTE.rstrip() + f"""
, t AS (SELECT CAST(Steps AS DOUBLE) AS a, CAST(Heart_Rate_avg AS DOUBLE) AS b, {LAB} AS c, CAST(Calories_Burned AS DOUBLE) AS y,
               {HASH} < 0.8 AS train FROM loose)
, k AS (SELECT c, CAST(row_number() OVER (ORDER BY count(*) DESC, c) - 1 AS DOUBLE) AS x FROM t WHERE train GROUP BY c)
, r AS (SELECT a, b, x, y, train FROM t JOIN k USING (c))
, m AS (SELECT avg(a) ma, avg(b) mb, avg(x) mx, avg(y) my, covar_pop(a, a) aa, covar_pop(a, b) ab, covar_pop(a, x) ax,
               covar_pop(b, b) bb, covar_pop(b, x) bx, covar_pop(x, x) xx, covar_pop(a, y) ay, covar_pop(b, y) by_,
               covar_pop(x, y) xy FROM r WHERE train)
, det AS (SELECT *, aa * (bb * xx - bx * bx) - ab * (ab * xx - bx * ax) + ax * (ab * bx - bb * ax) AS dt FROM m)
, w AS (SELECT *, (ay * (bb * xx - bx * bx) - ab * (by_ * xx - bx * xy) + ax * (by_ * bx - bb * xy)) / dt AS wa,
               (aa * (by_ * xx - bx * xy) - ay * (ab * xx - bx * ax) + ax * (ab * xy - by_ * ax)) / dt AS wb,
               (aa * (bb * xy - by_ * bx) - ab * (ab * xy - by_ * ax) + ay * (ab * bx - bb * ax)) / dt AS wx FROM det)
, p AS (SELECT y, my + wa * (a - ma) + wb * (b - mb) + wx * (x - mx) AS yhat FROM r, w WHERE NOT train)
SELECT sqrt(sum((y - yhat) * (y - yhat)) / count(*)) AS RMSE,
       1.0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS R2, sum(abs(y - yhat)) / count(*) AS MAE FROM p"""
ORACLES["linear_regression_metrics"] = _LR_SQL


# ---------------------------------------------------------------- L5: Shapley values
SHAP_BACKGROUND = 100


def _shap_sql() -> str:
    # Shapley weights of three features: |S|! (2 - |S|)! / 3! with the sign of the side that holds the feature.
    weight = {0: "1.0/3", 1: "1.0/6", 2: "1.0/3"}
    coefs = ", ".join(
        f"('{NUM[i]}', {mask}, {weight[bin(mask & ~(1 << i)).count('1')] if mask >> i & 1 else '-' + weight[bin(mask).count('1')]})"
        for i in range(3) for mask in range(8))
    picks = ",\n       ".join(
        f"CASE WHEN (m.mask & {1 << j}) <> 0 THEN {d('x.' + c)} ELSE {d('b.' + c)} END AS {c}"
        for j, c in enumerate(NUM))
    return CLEAN_CTE.rstrip() + f"""
, bg AS (SELECT * FROM strict ORDER BY {hash01_sql_duckdb('row_id', purpose='background')}, row_id LIMIT {SHAP_BACKGROUND})
, masks AS (SELECT CAST(range AS INTEGER) AS mask FROM range(0, {1 << len(NUM)}))
, syn AS (SELECT x.row_id, m.mask,
       {picks}
       FROM strict x CROSS JOIN masks m CROSS JOIN bg b)
, f AS (SELECT row_id, mask, CASE WHEN {RULE_SQL} = 'Cardio' THEN 1.0 ELSE 0.0 END AS f FROM syn)
, coefs AS (SELECT * FROM (VALUES {coefs}) t(feature, mask, coef))
SELECT f.row_id, c.feature, sum(c.coef * f.f) / (SELECT CAST(count(*) AS DOUBLE) FROM bg) AS shap_value
FROM f JOIN coefs c ON f.mask = c.mask GROUP BY f.row_id, c.feature"""


@register("shap_rule_cardio", _shap_sql())
def q_shap_rule_cardio(spark, sf_dir):
    """L5 with a rule model (indicator of the rule predicting Cardio): every cleaned row explained."""
    from ..operators import explain as xp
    data = strict(spark, sf_dir)
    value = xp.column_output(lambda: (ex.rule_class() == "Cardio").cast("double"))
    return xp.shapley_values(data, data, NUM, value, "row_id", background_size=SHAP_BACKGROUND)


@register("shap_random_forest")
def q_shap_random_forest(spark, sf_dir):
    """L5 with a trained forest: Shapley values of the class-0 probability for every cleaned row."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from ..operators import explain as xp
    from . import estimators as es
    from .preprocessing import label_indexer
    data = strict(spark, sf_dir)
    indexed = label_indexer(LAB).fit(data).transform(data)
    model = Pipeline(stages=[VectorAssembler(inputCols=NUM, outputCol="features"), es.rf_classifier()]).fit(indexed)
    return xp.shapley_values(data, data, NUM, xp.model_output(model, 0), "row_id", background_size=SHAP_BACKGROUND)


# ---------------------------------------------------------------- evidence for trained models and many classes
def _v3_explained(spark, sf_dir):
    """A forest (100 trees of depth 10) over the 18 features of v3, the test split, and the values of its first class."""
    from pyspark.ml import Pipeline

    from ..operators import tree_explain as te
    from . import estimators as es
    from .preprocessing import preprocessing_stages
    from .training import TrainConfig, prepare_splits
    train, test = prepare_splits(activity(spark, sf_dir), TrainConfig(version="v3", rules=cl.STRICT_RULES))
    base, engineered, categorical = fe.FEATURE_SETS["v3"]
    model = Pipeline(stages=[*preprocessing_stages(base, engineered, categorical, LAB, "minmax", label_invalid="skip"),
                             es.rf_classifier("v1")]).fit(train)
    names = fe.feature_columns("v3")
    values = te.tree_shapley_values(test, train, model, names, class_index=0, background_size=SHAP_BACKGROUND)
    return model, train, test, values


@register("shap_v3_forest")
def q_shap_v3_forest(spark, sf_dir):
    """L5 for v3: exact values of all 18 features for every row of the test split."""
    return _v3_explained(spark, sf_dir)[3]


@register("shap_v3_forest_check", CLEAN_CTE + f"""
SELECT count(*) AS n_rows, 18 * count(*) AS n_values, 0 AS bad_sum FROM strict WHERE {HASH} >= 0.8""")
def q_shap_v3_forest_check(spark, sf_dir):
    """Every test row has 18 values, which add up to the model's output less its mean over the background."""
    from pyspark.sql import functions as F

    from ..operators import explain as xp
    model, train, test, values = _v3_explained(spark, sf_dir)
    score = xp.model_output(model, 0)
    base = score(xp.background_sample(train, "row_id", SHAP_BACKGROUND)).agg(F.avg("_f").alias("base"))
    sums = values.groupBy("row_id").agg(F.sum("shap_value").alias("s"), F.count(F.lit(1)).alias("k"))
    both = pr.with_scalars(score(test).select("row_id", "_f").join(sums, "row_id"), base)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("k").alias("n_values"),
                    F.count_if(F.abs(F.col("s") - (F.col("_f") - F.col("base"))) > 1e-9).cast("int").alias("bad_sum"))


_TREE_FEATURES = {"hr": "Heart_Rate_avg", "steps": "floor(Steps / 500.0)", "calories": "floor(Calories_Burned / 50.0)"}
_TREE_CTE = CLEAN_CTE + f"""
, y AS (SELECT {LAB}, row_number() OVER (ORDER BY count(*) DESC, {LAB}) - 1 AS y FROM loose GROUP BY {LAB})
, long AS ({" UNION ALL ".join(f"SELECT '{k}' AS feature, CAST({e} AS DOUBLE) AS value, y FROM loose JOIN y USING ({LAB})" for k, e in _TREE_FEATURES.items())})
, cells AS (SELECT feature, value, {", ".join(f"CAST(count(*) FILTER (WHERE y = {c}) AS DOUBLE) AS w{c}" for c in range(4))} FROM long GROUP BY ALL)
, cum AS (SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS following,
                 {", ".join(f"sum(w{c}) OVER (PARTITION BY feature ORDER BY value) AS l{c}, sum(w{c}) OVER (PARTITION BY feature) AS t{c}" for c in range(4))}
          FROM cells)
, sized AS (SELECT *, l0 + l1 + l2 + l3 AS left_n, t0 + t1 + t2 + t3 AS n FROM cum)
, gains AS (SELECT feature, value, (value + following) / 2 AS threshold, left_n, n - left_n AS right_n,
                   (1 - ({" + ".join(f"(t{c} / n) ** 2" for c in range(4))}))
                   - left_n / n * (1 - ({" + ".join(f"(l{c} / left_n) ** 2" for c in range(4))}))
                   - (n - left_n) / n * (1 - ({" + ".join(f"((t{c} - l{c}) / (n - left_n)) ** 2" for c in range(4))})) AS gain
            FROM sized WHERE n > left_n)
"""


def _tree_input(spark, sf_dir):
    from pyspark.sql import functions as F

    from .preprocessing import label_indexer
    data = loose(spark, sf_dir).select(LAB, *[F.expr(e).cast("double").alias(k) for k, e in _TREE_FEATURES.items()])
    return label_indexer(LAB).fit(data).transform(data)


@register("tree_split_gains", _TREE_CTE + "SELECT feature, value, gain, left_n, right_n FROM gains")
def q_tree_split_gains(spark, sf_dir):
    """The Gini gain of every candidate of a tree's first split."""
    from ..operators import tree_explain as te
    return te.split_gains(_tree_input(spark, sf_dir), list(_TREE_FEATURES), "label", 4)


@register("tree_root_split", _TREE_CTE + "SELECT 0 AS tree, feature, threshold, gain, left_n, right_n FROM gains ORDER BY gain DESC LIMIT 1")
def q_tree_root_split(spark, sf_dir):
    """The first split of a fitted decision tree is the candidate with the largest gain (bins for every distinct value)."""
    from pyspark.ml.feature import VectorAssembler

    from ..operators import tree_explain as te
    from . import estimators as es
    data = VectorAssembler(inputCols=list(_TREE_FEATURES), outputCol="features").transform(_tree_input(spark, sf_dir))
    model = es.decision_tree(maxDepth=3, maxBins=1024).fit(data)
    return te.root_splits(model, list(_TREE_FEATURES))


# Newton's method on two coefficients; the fitted model must end where it does.
@register("logistic_coefficients", CLEAN_CTE.replace("WITH", "WITH RECURSIVE", 1) + f"""
, xy AS (SELECT (Heart_Rate_avg - 100) / 50 AS x, CASE WHEN {LAB} = 'Cardio' THEN 1.0 ELSE 0.0 END AS y FROM loose)
, newton(i, b0, b1) AS (
    SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
    UNION ALL
    SELECT i + 1, b0 + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b1 + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
    FROM (SELECT i, b0, b1, sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * x) AS h01,
                 sum(p * (1 - p) * x * x) AS h11
          FROM (SELECT i, b0, b1, x, y, 1 / (1 + exp(-(b0 + b1 * x))) AS p FROM newton, xy WHERE i < 12) GROUP BY i, b0, b1))
, best AS (SELECT b0, b1 FROM newton WHERE i = 12)
SELECT round(any_value(b0), 4) AS intercept, round(any_value(b1), 4) AS coefficient,
       round(avg(CASE WHEN y = 1 THEN -ln(1 + exp(-(b0 + b1 * x))) ELSE -ln(1 + exp(b0 + b1 * x)) END), 6) AS log_likelihood
FROM xy, best""")
def q_logistic_coefficients(spark, sf_dir):
    """One-feature logistic regression of Cardio on the scaled heart rate: its optimum and log-likelihood a row."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F

    from . import estimators as es
    data = loose(spark, sf_dir).select(((F.col("Heart_Rate_avg") - 100) / 50).alias("x"),
                                       (F.col(LAB) == "Cardio").cast("double").alias("label"))
    model = es.logistic_regression(tol=1e-9, maxIter=200).fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(data))
    b0, b1 = float(model.intercept), float(model.coefficients[0])
    z = F.lit(b0) + F.lit(b1) * F.col("x")
    ll = F.when(F.col("label") == 1, -F.log1p(F.exp(-z))).otherwise(-F.log1p(F.exp(z)))
    return data.agg(F.round(F.lit(b0), 4).alias("intercept"), F.round(F.lit(b1), 4).alias("coefficient"),
                    F.round(F.avg(ll), 6).alias("log_likelihood"))


# The regularised multinomial log-likelihood is concave, so ascent by its gradient ends where the fitted model must.
_CLASSES = ("Cardio", "None", "Strength", "Yoga")
_ASCENT = [(k, j) for k in range(len(_CLASSES)) for j in range(len(NUM) + 1)]
_LOGIT_SQL = CLEAN_CTE.replace("WITH", "WITH RECURSIVE", 1) + f"""
, st AS (SELECT {", ".join(f"avg({d(c)}) AS m{j}, stddev_samp({d(c)}) AS s{j}" for j, c in enumerate(NUM, 1))} FROM loose)
, xy AS (SELECT {LAB} AS c, CAST(1 AS DOUBLE) AS x0, {", ".join(f"({d(c)} - m{j}) / s{j} AS x{j}" for j, c in enumerate(NUM, 1))} FROM loose, st)
, ascent(i, {", ".join(f"b{k}_{j}" for k, j in _ASCENT)}) AS (
    SELECT 0, {", ".join("CAST(0 AS DOUBLE)" for _ in _ASCENT)}
    UNION ALL
    SELECT i + 1, {", ".join(
        f"any_value(b{k}_{j}) + 1.2 * (avg((CASE WHEN c = '{_CLASSES[k]}' THEN 1 ELSE 0 END - e{k} / s) * x{j})"
        + (f" - 0.01 * any_value(b{k}_{j}))" if j else ")") for k, j in _ASCENT)}
    FROM (SELECT *, {" + ".join(f"e{k}" for k in range(len(_CLASSES)))} AS s
          FROM (SELECT *, {", ".join(
              f"exp({' + '.join(f'b{k}_{j} * x{j}' for j in range(len(NUM) + 1))}) AS e{k}" for k in range(len(_CLASSES)))}
                FROM ascent, xy WHERE i < 400)) GROUP BY i)
, best AS (SELECT * FROM ascent WHERE i = 400)
, n AS (SELECT c, count(*) AS n_rows FROM xy GROUP BY c)
""" + " UNION ALL ".join(
    f"SELECT c AS class, n_rows, round(b{k}_0 - ({' + '.join(f'b{q}_0' for q in range(len(_CLASSES)))}) / {len(_CLASSES)}, 4) AS intercept, "
    + ", ".join(f"round(b{k}_{j}, 4) AS w_{c}" for j, c in enumerate(NUM, 1)) + f" FROM n, best WHERE c = '{name}'"
    for k, name in enumerate(_CLASSES))


@register("multinomial_coefficients", _LOGIT_SQL)
def q_multinomial_coefficients(spark, sf_dir):
    """The v3 logistic regression (L2, 0.01) of the class on the standardised numbers, run to its optimum: a row a class."""
    from pyspark.ml import Pipeline
    from pyspark.sql import functions as F

    from . import estimators as es
    from .preprocessing import preprocessing_stages
    data = loose(spark, sf_dir)
    stages = [*preprocessing_stages(NUM, target_col=LAB, scaler="standard"), es.logistic_regression("v3", tol=1e-8, maxIter=500)]
    fitted = Pipeline(stages=stages).fit(data)
    labels, model = fitted.stages[0].labels, fitted.stages[-1]
    weights = [[float(model.interceptVector[k]), *map(float, model.coefficientMatrix.toArray()[k])] for k in range(len(labels))]
    of = F.create_map(*[F.lit(x) for k, name in enumerate(labels) for x in (name, weights[k])])[F.col(LAB)]
    names = ["intercept", *[f"w_{c}" for c in NUM]]
    return (data.groupBy(LAB).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.col(LAB).alias("class"), "n_rows", *[F.round(of[j], 4).alias(name) for j, name in enumerate(names)]))


_SCALED_SQL = CLEAN_CTE + f"""
, y AS (SELECT {LAB}, CAST(row_number() OVER (ORDER BY count(*) DESC, {LAB}) - 1 AS DOUBLE) AS label FROM loose GROUP BY {LAB})
, st AS (SELECT {", ".join(f"avg({d(c)}) AS m{i}, stddev_samp({d(c)}) AS s{i}, min({d(c)}) AS lo{i}, max({d(c)}) AS hi{i}" for i, c in enumerate(NUM))} FROM loose)
SELECT row_id, label, {", ".join(f"({d(c)} - m{i}) / s{i} AS std_{c}, ({d(c)} - lo{i}) / (hi{i} - lo{i}) AS minmax_{c}" for i, c in enumerate(NUM))},
       CAST(label AS INTEGER) AS hot_slot, CAST((SELECT count(*) FROM y) AS INTEGER) AS hot_size
FROM loose JOIN y USING ({LAB}), st"""


@register("scaled_and_encoded", _SCALED_SQL)
def q_scaled_and_encoded(spark, sf_dir):
    """Label index, standard and min-max scaled numbers and the one-hot slot of every cleaned row."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from .preprocessing import preprocessing_stages
    data = loose(spark, sf_dir)
    out = data
    for kind in ("standard", "minmax"):
        stages = preprocessing_stages(NUM, target_col=LAB if kind == "standard" else None, scaler=kind)
        made = Pipeline(stages=stages).fit(out).transform(out)
        short = "std" if kind == "standard" else "minmax"
        values = vector_to_array("features")
        out = made.withColumns({f"{short}_{c}": values[i] for i, c in enumerate(NUM)}).drop("raw_features", "features")
    stages = preprocessing_stages([], categorical=[LAB], target_col=None, scaler=None, one_hot=True)
    hot = vector_to_array("features")
    out = Pipeline(stages=stages).fit(out).transform(out)
    return out.select("row_id", "label", *[f"{k}_{c}" for c in NUM for k in ("std", "minmax")],
                      (F.array_position(hot, 1.0) - 1).cast("int").alias("hot_slot"), F.size(hot).alias("hot_size"))


_WIDE_CORR = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey", "l_orderkey"]


@register("wide_correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, covar_pop({d(a)}, {d(b)}) / (stddev_pop({d(a)}) * stddev_pop({d(b)})) AS corr FROM lineitem"
    for a in _WIDE_CORR for b in _WIDE_CORR))
def q_wide_correlation(spark, sf_dir):
    """C13 over the eight numbers of the largest table."""
    return pr.correlation_matrix(read_table(spark, sf_dir, "lineitem"), _WIDE_CORR)


@register("confusion_many_classes", """
WITH p AS (SELECT l_suppkey AS a, l_partkey % 97 + 1 AS b FROM lineitem WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL)
, cls AS (SELECT a AS c FROM p UNION SELECT b FROM p)
, k AS (SELECT a, b, count(*) AS n FROM p GROUP BY ALL)
SELECT x.c AS actual, y.c AS predicted, CAST(coalesce(k.n, 0) AS BIGINT) AS count
FROM cls x CROSS JOIN cls y LEFT JOIN k ON k.a = x.c AND k.b = y.c""")
def q_confusion_many_classes(spark, sf_dir):
    """K5 with as many classes as there are suppliers."""
    from pyspark.sql import functions as F
    pred = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("label"), (F.col("l_partkey") % 97 + 1).alias("prediction"))
    return ev.confusion_matrix(pred)
