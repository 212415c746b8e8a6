"""Cleaning and data-quality audit.

``validate_and_clean`` returns the cleaned DataFrame (lazy) and a one-row audit computed in a single aggregation
over the input instead of one ``count()`` action per step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import safe_div

# A rule is (low, high, low_inclusive, high_inclusive); None means unbounded on that side.
Rule = tuple

# The reference's validity ranges.
LOOSE_RULES: dict[str, Rule] = {
    "Steps": (0, None, True, True),
    "Heart_Rate_avg": (0, None, False, True),
    "Calories_Burned": (0, None, True, True),
}
STRICT_RULES: dict[str, Rule] = {
    "Steps": (0, 50000, True, True),
    "Heart_Rate_avg": (50, 220, True, True),
    "Calories_Burned": (0, 5000, True, True),
}


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """B2: drop rows with a NULL in any of ``subset`` (all columns by default)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def not_null_predicate(cols: Sequence[str]) -> Column:
    """B6 over several columns: all present."""
    pred = F.lit(True)
    for c in cols:
        pred = pred & F.col(c).isNotNull()
    return pred


def validity_predicate(rules: Mapping[str, Rule]) -> Column:
    """Conjunction of range rules; simple comparisons, so Parquet can take them as pushed filters."""
    pred = F.lit(True)
    for c, (lo, hi, lo_incl, hi_incl) in rules.items():
        x = F.col(c)
        if lo is not None:
            pred = pred & ((x >= F.lit(lo)) if lo_incl else (x > F.lit(lo)))
        if hi is not None:
            pred = pred & ((x <= F.lit(hi)) if hi_incl else (x < F.lit(hi)))
    return pred


def filter_valid(df: DataFrame, rules: Mapping[str, Rule] = LOOSE_RULES) -> DataFrame:
    return df.where(validity_predicate(rules))


def filter_class(df: DataFrame, label_col: str, value: str) -> DataFrame:
    """Rows of one class. For several classes prefer a ``groupBy`` over a loop of these."""
    return df.where(F.col(label_col) == F.lit(value))


def clean(df: DataFrame, rules: Mapping[str, Rule] = LOOSE_RULES, subset: Sequence[str] | None = None) -> DataFrame:
    """B2 then B3/B4: drop rows with NULLs, keep rows inside the rules."""
    return filter_valid(drop_nulls(df, subset), rules)


def cleaning_report(df: DataFrame, rules: Mapping[str, Rule] = LOOSE_RULES, subset: Sequence[str] | None = None,
                    relative_to: str = "step") -> DataFrame:
    """``initial_count, after_dropna, final_count, dropna_removed_pct, filter_removed_pct`` in one job.

    ``relative_to="step"`` (v1/v2) divides each step's removals by that step's input; ``"initial"`` (v3) divides
    by the initial count. Percentages are NULL when the denominator is 0.
    """
    cols = list(subset) if subset else df.columns
    complete = not_null_predicate(cols)
    row = df.agg(F.count(F.lit(1)).alias("initial_count"),
                 F.count_if(complete).alias("after_dropna"),
                 F.count_if(complete & validity_predicate(rules)).alias("final_count"))
    first = F.col("initial_count") - F.col("after_dropna")
    second = F.col("after_dropna") - F.col("final_count")
    if relative_to == "step":
        den2 = F.col("after_dropna")
    elif relative_to == "initial":
        den2 = F.col("initial_count")
    else:
        raise ValueError("relative_to must be 'step' or 'initial'")
    return row.select(
        F.col("initial_count").cast("long").alias("initial_count"),
        F.col("after_dropna").cast("long").alias("after_dropna"),
        F.col("final_count").cast("long").alias("final_count"),
        (safe_div(first, F.col("initial_count")) * 100).alias("dropna_removed_pct"),
        (safe_div(second, den2) * 100).alias("filter_removed_pct"),
        (safe_div(F.col("initial_count") - F.col("final_count"), F.col("initial_count")) * 100)
        .alias("total_removed_pct"))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``column, null_count, null_pct`` for every column, from one aggregation."""
    cols = list(cols) if cols else df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"z{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"z{i}").cast("long").alias("null_count"),
                        (safe_div(F.col(f"z{i}"), F.col("_n")) * 100).alias("null_pct")) for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*structs)))


def validate_and_clean(df: DataFrame, rules: Mapping[str, Rule] = LOOSE_RULES, subset: Sequence[str] | None = None,
                       relative_to: str = "step") -> tuple[DataFrame, DataFrame]:
    """``(clean_df, report_df)``. Both are lazy; the report is one aggregation over the input."""
    return clean(df, rules, subset), cleaning_report(df, rules, subset, relative_to)
