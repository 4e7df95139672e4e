"""Time literals without zone, sentinels and stamps."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Open ends of a version's [valid_from, valid_to).
BEGINNING = datetime(1900, 1, 1)
END = datetime(9999, 12, 31)


def utc_naive(ts: datetime) -> datetime:
    return ts.astimezone(timezone.utc).replace(tzinfo=None) if ts.tzinfo else ts


def timestamp(ts: datetime | Column) -> Column:
    """Literal of type TIMESTAMP_NTZ; aware times are turned into UTC first."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    return F.lit(utc_naive(ts).isoformat(sep=" ")).cast("timestamp_ntz")


def run_stamp(run_ts: datetime) -> Column:
    """``dbt_run_started_at``: when the run began, to the second."""
    return timestamp(utc_naive(run_ts).replace(microsecond=0)).alias("dbt_run_started_at")


def with_loaded_at(df: DataFrame, loaded_at: datetime) -> DataFrame:
    """Add ``etl_loaded_at``: one value for all rows and tables of a load."""
    return df.withColumn("etl_loaded_at", timestamp(loaded_at))
