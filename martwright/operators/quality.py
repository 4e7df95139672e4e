"""Checks. Each returns the violations of a rule as rows; none means the rule holds.

Counts are combined before they are shuffled, so that a value with a large share of the rows
costs one row per task. NULL is left to ``not_null``: the other checks skip it, but for those that
group by a key, ``unique_combination`` and the two on current versions, where NULL is a key.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    present = df.filter(F.col(column).isNotNull())
    return _repeated(present.groupBy(F.col(column).alias("unique_field")))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations of values that occur more than once, with their count."""
    return _repeated(df.groupBy(*columns))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows of ``child`` whose ``column`` isn't found in ``parent``."""
    known = parent.select(F.col(field).alias("__known"))
    return child.filter(F.col(column).isNotNull()).join(known, F.col(column) == F.col("__known"), "left_anti")


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Values of ``column`` not found in ``parent``, with their ``violations``: the number of rows that
    ``relationships`` returns, but distinct values are joined instead of rows."""
    values = child.groupBy(column).agg(F.count("*").alias("violations"))
    return relationships(values, column, parent, field)


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside ``values``, with their count."""
    outside = df.filter(~F.col(column).isin(values))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def one_current(dim: DataFrame, natural_key: str) -> DataFrame:
    """Keys with more than one current version."""
    current = dim.filter("is_current").groupBy(natural_key)
    return current.agg(F.count("*").alias("current_version_count")).filter("current_version_count <> 1")


def one_current_strict(dim: DataFrame, natural_key: str) -> DataFrame:
    """Keys with more than one current version, or with none: ``one_current`` can't see the latter."""
    versions = dim.groupBy(natural_key)
    return versions.agg(F.count_if(F.col("is_current")).alias("current_version_count")).filter(
        "current_version_count <> 1"
    )


def split_difference() -> Column:
    parts = F.col("prf_amount") + F.col("pif_amount") + F.col("wakalah_fee_shareholders_fund")
    return F.col("gross_amount") - parts


def split_is_off(tolerance: str = "0.01") -> Column:
    return F.abs(split_difference()) > F.lit(Decimal(tolerance))


def fund_split(contributions: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Contributions whose parts don't add up to the gross amount, with the difference."""
    money = ["gross_amount", "prf_amount", "pif_amount", "wakalah_fee_shareholders_fund"]
    return contributions.filter(split_is_off(tolerance)).select(
        "contribution_id", *money, split_difference().alias("diff")
    )


def fund_leakage(fact: DataFrame, dim: DataFrame, key: str = "policy_sk") -> DataFrame:
    """Contributions with an investment part although their policy has none.

    Both filters apply before the join, so only suspicious rows are joined.
    """
    without = dim.filter(~F.col("has_pif")).select(F.col(key).alias("__key"), "has_pif")
    leaking = fact.filter(F.col("pif_amount") != 0)
    return leaking.join(without, F.col(key) == F.col("__key")).select(
        "contribution_id", "policy_id", "pif_amount", "has_pif"
    )


def leak_counts(fact: DataFrame, dim: DataFrame, key: str = "policy_sk") -> DataFrame:
    """The number of rows ``fund_leakage`` returns, as ``violations`` per policy version: facts are
    counted before they are joined."""
    counts = fact.filter(F.col("pif_amount") != 0).groupBy(key).agg(F.count("*").alias("violations"))
    return counts.join(dim.filter(~F.col("has_pif")).select(key), key)


def dependency(df: DataFrame, determinant: str, dependent: str) -> DataFrame:
    """Values of ``determinant`` that occur with more than one value of ``dependent``."""
    groups = df.groupBy(determinant).agg(F.countDistinct(dependent).alias("n_values"))
    return groups.filter("n_values > 1")


def single_value(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def scd_overlap(dim: DataFrame, natural_key: str) -> DataFrame:
    """Versions that begin inside an earlier version of their key.

    One row per such version (b), with the earlier version that reaches furthest (a): the
    offending versions are those a self join would pair up, but the result stays linear.
    Versions with equal starts are left to ``unique_combination``.
    """
    reached = _with_earlier_reach(dim, natural_key).filter(F.col("reach.valid_to") > F.col("valid_from"))
    return reached.select(
        natural_key,
        F.col("reach.valid_from").alias("a_valid_from"),
        F.col("reach.valid_to").alias("a_valid_to"),
        F.col("valid_from").alias("b_valid_from"),
        F.col("valid_to").alias("b_valid_to"),
    )


def scd_gaps(dim: DataFrame, natural_key: str) -> DataFrame:
    """Versions that begin after all earlier versions of their key have ended."""
    reached = _with_earlier_reach(dim, natural_key).filter(F.col("reach.valid_to") < F.col("valid_from"))
    return reached.select(
        natural_key, F.col("reach.valid_to").alias("gap_from"), F.col("valid_from").alias("gap_to")
    )


def _with_earlier_reach(dim: DataFrame, natural_key: str) -> DataFrame:
    """Distinct versions with ``reach``: among the versions of the key that start before this one
    does (and before it ends, should its ends be swapped), the (valid_to, valid_from) that is greatest.

    A running maximum per key. A key may hold a large share of the rows, so it is taken in two
    steps: within the key's rows of one day, and over the maxima of its days, of which there
    are at most some ten thousand; the answer is the greater one. Copies of a version collapse
    beforehand.
    """
    versions = dim.filter(F.col(natural_key).isNotNull()).select(natural_key, "valid_from", "valid_to").distinct()
    reach = F.struct("valid_to", "valid_from")
    nothing = F.lit(None).cast("struct<valid_to: timestamp_ntz, valid_from: timestamp_ntz>")
    # At equal times a question (0) sorts before a start (1): a version isn't earlier than itself.
    start = F.struct(F.col("valid_from").alias("at"), F.lit(1).alias("kind"), reach.alias("reach"))
    ask = F.struct(F.least("valid_from", "valid_to").alias("at"), F.lit(0).alias("kind"), nothing.alias("reach"))
    marks = versions.select("*", F.inline(F.array(start, ask))).withColumn("on_day", F.col("at").cast("date"))

    in_day = Window.partitionBy(natural_key, "on_day").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    asked = marks.withColumn("near", F.max("reach").over(in_day)).filter("kind = 0")
    earlier = Window.partitionBy(natural_key).orderBy("on_day").rowsBetween(Window.unboundedPreceding, -1)
    days = marks.groupBy(natural_key, "on_day").agg(F.max("reach").alias("far"))
    carried = days.withColumn("far", F.max("far").over(earlier))
    return asked.join(carried, [natural_key, "on_day"]).select(
        natural_key, "valid_from", "valid_to", F.greatest("near", "far").alias("reach")
    )


def _repeated(grouped) -> DataFrame:
    return grouped.agg(F.count("*").alias("n_records")).filter("n_records > 1")
