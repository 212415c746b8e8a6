"""Column expressions shared by the operators: safe division, bucket rules, verdict labels, index-to-label lookup.

Everything here is a built-in Spark expression, so it stays inside whole-stage codegen; nothing calls Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``num / den`` that yields NULL instead of raising when ``den`` is 0 (ANSI mode) or NULL."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def threshold_buckets(c: Column | str, upper_bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """First-match ``when`` chain: ``labels[i]`` for ``c < upper_bounds[i]``, else ``labels[-1]``.

    Like the reference's chains, a NULL input matches no ``when`` and falls to the last label.
    """
    if len(labels) != len(upper_bounds) + 1:
        raise ValueError("need one more label than bounds")
    x = col_(c)
    expr = None
    for bound, label in zip(upper_bounds, labels[:-1]):
        expr = F.when(x < F.lit(bound), F.lit(label)) if expr is None else expr.when(x < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


# Bucket bounds and labels of the reference's feature rules.
HR_ZONE_BOUNDS = [100, 140, 170]
HR_ZONE_LABELS = ["Low", "Moderate", "High", "Maximum"]
STEPS_CATEGORY_BOUNDS = [5000, 10000, 15000]
STEPS_CATEGORY_LABELS = ["Sedentary", "Low_Active", "Active", "Very_Active"]
HR_ZONE_DETAILED_BOUNDS = [90, 110, 130, 150, 170]
HR_ZONE_DETAILED_LABELS = ["Rest", "Light", "Moderate", "Vigorous", "High", "Maximum"]


def hr_zone(hr: Column | str = "Heart_Rate_avg") -> Column:
    return threshold_buckets(hr, HR_ZONE_BOUNDS, HR_ZONE_LABELS)


def steps_category(steps: Column | str = "Steps") -> Column:
    return threshold_buckets(steps, STEPS_CATEGORY_BOUNDS, STEPS_CATEGORY_LABELS)


def hr_zone_detailed(hr: Column | str = "Heart_Rate_avg") -> Column:
    return threshold_buckets(hr, HR_ZONE_DETAILED_BOUNDS, HR_ZONE_DETAILED_LABELS)


# The activity-pattern rule, in order (first match wins): (steps op, steps bound, hr op, hr bound,
# label); rows matching none get PATTERN_DEFAULT.
PATTERN_RULES = [
    (">", 10000, ">", 140, "High_Intensity_Cardio"),
    ("<", 5000, "<", 120, "Low_Intensity"),
    ("<", 8000, ">", 130, "Strength_Like"),
]
PATTERN_DEFAULT = "Moderate_Activity"


def _compare(x: Column, op: str, bound: float) -> Column:
    return x > F.lit(bound) if op == ">" else x < F.lit(bound)


def _pattern_chain(steps: Column | str, hr: Column | str, rename: dict | None = None) -> Column:
    s, h = col_(steps), col_(hr)
    name = (lambda label: rename[label]) if rename else (lambda label: label)
    expr = None
    for s_op, s_bound, h_op, h_bound, label in PATTERN_RULES:
        cond = _compare(s, s_op, s_bound) & _compare(h, h_op, h_bound)
        expr = F.when(cond, F.lit(name(label))) if expr is None else expr.when(cond, F.lit(name(label)))
    return expr.otherwise(F.lit(name(PATTERN_DEFAULT)))


def activity_pattern(steps: Column | str = "Steps", hr: Column | str = "Heart_Rate_avg") -> Column:
    """Two-column rule; order matters (first match wins)."""
    return _pattern_chain(steps, hr)


# Verdict labels (B17). Thresholds and wording.
def ks_verdict(p_value: Column | str, alpha: float = 0.05) -> Column:
    p = col_(p_value)
    return F.when(p.isNull(), F.lit(None).cast("string")) \
        .when(p < alpha, F.lit("NOT normally distributed")).otherwise(F.lit("looks normal-ish"))


def jsd_verdict(jsd: Column | str) -> Column:
    j = col_(jsd)
    return F.when(j.isNull(), F.lit(None).cast("string")).when(j < 0.05, F.lit("Very similar")) \
        .when(j < 0.2, F.lit("Somewhat different")).otherwise(F.lit("Noticeably different"))


def accuracy_verdict(accuracy: Column | str) -> Column:
    a = col_(accuracy)
    return F.when(a.isNull(), F.lit(None).cast("string")).when(a > 0.8, F.lit("EXCELLENT")) \
        .when(a > 0.6, F.lit("GOOD")).when(a > 0.4, F.lit("MODERATE")).otherwise(F.lit("POOR"))


def overfitting_flag(gap: Column | str, threshold: float = 0.15) -> Column:
    return col_(gap) > F.lit(threshold)


def imbalance_flag(ratio: Column | str, threshold: float = 5.0) -> Column:
    return col_(ratio) > F.lit(threshold)


def index_to_label(prediction: Column | str, labels: Sequence[str], unknown: str = "Unknown") -> Column:
    """H1 without a UDF: index ``i`` (a double from a classifier) -> ``labels[i]``, ``unknown`` if out of range."""
    arr = F.array(*[F.lit(x) for x in labels]) if labels else F.array().cast("array<string>")
    idx = col_(prediction).cast("int") + F.lit(1)
    return F.coalesce(F.when(idx >= 1, F.try_element_at(arr, F.greatest(idx, F.lit(1)))), F.lit(unknown))


# A deterministic rule classifier: the activity pattern read as a workout class. It is the stand-in predictor that
# lets evaluation operators be checked against SQL (trained predictions have no SQL form).
PATTERN_CLASS = {
    "High_Intensity_Cardio": "Cardio",
    "Strength_Like": "Strength",
    "Low_Intensity": "Yoga",
    "Moderate_Activity": "None",
}


def rule_class(steps: Column | str = "Steps", hr: Column | str = "Heart_Rate_avg") -> Column:
    """The pattern rule with class names as labels: one CASE over the two columns, no string round trip."""
    return _pattern_chain(steps, hr, PATTERN_CLASS)


# A fixed linear formula used as the stand-in regressor for Calories_Burned.
LINEAR_RULE = {"intercept": 50.0, "Steps": 0.01, "Heart_Rate_avg": 0.5}


def linear_rule(steps: Column | str = "Steps", hr: Column | str = "Heart_Rate_avg") -> Column:
    return (F.lit(LINEAR_RULE["intercept"]) + F.lit(LINEAR_RULE["Steps"]) * col_(steps).cast("double")
            + F.lit(LINEAR_RULE["Heart_Rate_avg"]) * col_(hr).cast("double"))
