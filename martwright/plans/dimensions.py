"""The four dimensions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.audit import BEGINNING, END, run_stamp, timestamp
from martwright.functions.calendar import calendar_columns, date_spine
from martwright.functions.keys import surrogate_key
from martwright.operators.history import mark_first
from martwright.schemas import FIRST_VERSION, VALID_FROM, VALID_TO, as_mart

# The calendar covers these days, the end excluded.
CALENDAR_START, CALENDAR_END = date(2020, 1, 1), date(2048, 1, 1)

# Columns whose change opens a new version.
TRACKED = {
    "policies": ["status", "agent_id", "contribution_amount"],
    "participants": ["state"],
}
NATURAL_KEYS = {"policies": "policy_id", "participants": "participant_id"}

#: Columns that always show the latest extract, whatever version the row is.
OVERWRITTEN = {"participants": ["full_name", "ic_number", "date_of_birth", "gender", "join_date"]}


def version_columns() -> list[Column]:
    """``valid_from``, ``valid_to``, ``is_current`` from a history.

    The first version reaches back to the beginning of time: facts older than the first run
    belong to it.
    """
    return [
        F.when(F.col(FIRST_VERSION), timestamp(BEGINNING)).otherwise(F.col(VALID_FROM)).alias("valid_from"),
        F.coalesce(F.col(VALID_TO), timestamp(END)).alias("valid_to"),
        F.col(VALID_TO).isNull().alias("is_current"),
    ]


def type2_dimension(
    history: DataFrame,
    key: str,
    surrogate: str,
    run_ts: datetime,
    current: DataFrame | None = None,
    overwritten: list[str] | None = None,
) -> DataFrame:
    """One row per version: surrogate key, attributes and ``[valid_from, valid_to)``.

    ``overwritten`` columns are taken from ``current``, the latest staging, by a left join: a
    key absent there gets NULL. The others stay as the version recorded them.
    """
    if FIRST_VERSION not in history.columns:
        history = mark_first(history, key)
    if current is not None and overwritten:
        kept = [c for c in history.columns if c not in overwritten]
        history = history.select(*kept).join(current.select(key, *overwritten), key, "left")
    return history.select(
        "*", surrogate_key(key, VALID_FROM).alias(surrogate), *version_columns(), run_stamp(run_ts)
    )


def dim_policies(history: DataFrame, run_ts: datetime) -> DataFrame:
    return as_mart(type2_dimension(history, "policy_id", "policy_sk", run_ts), "dim_policies")


def dim_participants(history: DataFrame, staged: DataFrame, run_ts: datetime) -> DataFrame:
    versions = type2_dimension(
        history, "participant_id", "participant_sk", run_ts, staged, OVERWRITTEN["participants"]
    )
    return as_mart(versions, "dim_participants")


def dim_product(policies: DataFrame, run_ts: datetime) -> DataFrame:
    pairs = policies.select("product_name", "product_category").distinct()
    return as_mart(
        pairs.select("*", surrogate_key("product_name").alias("product_sk"), run_stamp(run_ts)), "dim_product"
    )


def dim_date(
    spark: SparkSession, run_ts: datetime, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    days = date_spine(spark, start, end)
    return as_mart(days.select("date_day", *calendar_columns(F.col("date_day")), run_stamp(run_ts)), "dim_date")
