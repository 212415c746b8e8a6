"""The ``activity`` table derived from ``events`` (see FIXTURES.md, F1).

The SQL text is shared verbatim between Spark and the DuckDB oracle so that both engines see identical rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# The derivation of the activity fixture from `events`, identical in Spark and DuckDB.
ACTIVITY_SELECT = """
SELECT event_id AS row_id,
  CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 61 = 0 THEN -1 WHEN event_id % 73 = 0 THEN 60000
       ELSE CAST((event_id * 7919) % 20011 AS BIGINT) END AS Steps,
  CASE WHEN event_id % 59 = 0 THEN NULL
       ELSE CAST(45 + (user_id * 37 + event_id * 13) % 150
            + CASE event_type WHEN 'click' THEN 40 WHEN 'view' THEN 20 ELSE 0 END AS DOUBLE) END AS Heart_Rate_avg,
  CASE WHEN event_id % 67 = 0 THEN NULL ELSE value * 20 END AS Calories_Burned,
  CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_type = 'click' THEN 'Cardio' WHEN event_type = 'view' THEN 'Strength'
       WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'Yoga' ELSE 'None' END AS Workout_Type
FROM {events}
"""

NUMERIC_COLS = ["Steps", "Heart_Rate_avg", "Calories_Burned"]
LABEL_COL = "Workout_Type"
KEY_COL = "row_id"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The F1 fixture as a DataFrame over ``events``; only the four columns it needs are read from parquet."""
    events = read_table(spark, sf_dir, "events")
    return spark.sql(ACTIVITY_SELECT, events=events)


def activity_cte() -> str:
    """``WITH activity AS (...)`` prefix for DuckDB oracles (``events`` is a pre-registered view there)."""
    return "WITH activity AS (" + ACTIVITY_SELECT.format(events="events") + ")\n"
