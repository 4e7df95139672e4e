"""Days as rows, and the calendar attributes of a day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` up to, but without, ``end``."""
    days = spark.range((end - start).days)
    return days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))


def calendar_columns(day: Column) -> list[Column]:
    """Calendar attributes of ``day``; weekdays count from 0 = Sunday."""
    weekday = F.dayofweek(day) - 1
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    ]
