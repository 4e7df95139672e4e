"""Effective-date joins: each fact gets the dimension version in effect on its date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Versions of one key from which ``asof_join_by_day`` pays off. Comparing a fact with each of so
#: many versions costs more than joining it a second time.
LONG_HISTORY = 500
#: Keys with long histories that may be broadcast; at 64 bytes a key, some 6 MB.
MOST_LONG = 100_000

AsofJoin = Callable[[DataFrame, DataFrame, str, str, list[str]], DataFrame]


def asof_join(
    fact: DataFrame, dim: DataFrame, key: str, date_col: str, take: list[str], how: str = "left"
) -> DataFrame:
    """Join on ``key`` where ``valid_from <= date_col < valid_to``.

    An equi join with the range as residual condition: Spark broadcasts the narrow dimension
    side if its measured size allows, else sorts and merges by key; a key with a large share
    of the facts is then split by AQE, as the fact side of a left join may be. A fact without
    a version keeps NULLs; overlapping versions repeat it, which the uniqueness check on the
    fact reports.
    """
    versions = dim.select(
        F.col(key).alias("__key"),
        F.col("valid_from").alias("__from"),
        F.col("valid_to").alias("__to"),
        *[F.col(c).alias(f"__take_{c}") for c in take],
    )
    effective = (
        (F.col(key) == F.col("__key")) & (F.col(date_col) >= F.col("__from")) & (F.col(date_col) < F.col("__to"))
    )
    joined = fact.join(versions, effective, how)
    return joined.select(*fact.columns, *[F.col(f"__take_{c}").alias(c) for c in take])


def asof_join_by_day(fact: DataFrame, dim: DataFrame, key: str, date_col: str, take: list[str]) -> DataFrame:
    """Same result as ``asof_join``, for keys with very many facts and versions.

    The version depends on key and date only, so each distinct pair is resolved once and the
    answer joined back. The distinct is combined before the shuffle, which shrinks a hot key to
    one row per day; the join back is on both columns, which spreads it over as many tasks as
    it has days, and versions aren't compared again for every fact.
    """
    days = fact.select(key, date_col).distinct()
    resolved = asof_join(days, dim, key, date_col, take, how="inner")
    return fact.join(resolved, [key, date_col], "left").select(*fact.columns, *take)


def choose_asof_join(dim: DataFrame, key: str, long_history: int = LONG_HISTORY, most_long: int = MOST_LONG) -> AsofJoin:
    """The as-of join that suits ``dim``, which is aggregated once to find out.

    Without a key of more than ``long_history`` versions it is ``asof_join``. Else those keys go through
    ``asof_join_by_day``; up to ``most_long`` of them are broadcast to tell the facts apart, since a join on
    the key that shuffles would keep AQE from splitting a hot key of the as-of join after it. Where there are
    more, all facts go through ``asof_join_by_day``. The fact is read twice in the second case, so it
    should be stored.
    """
    versions = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__versions"))
    long = versions.filter(F.col("__versions") > long_history).select(key)
    found = long.limit(most_long + 1).count()
    if not found:
        return asof_join
    if found > most_long:
        return asof_join_by_day

    def split(fact: DataFrame, dim: DataFrame, key: str, date_col: str, take: list[str]) -> DataFrame:
        usual = asof_join(fact.join(F.broadcast(long), key, "left_anti"), dim, key, date_col, take)
        many = asof_join_by_day(fact.join(F.broadcast(long), key, "left_semi"), dim, key, date_col, take)
        return usual.unionByName(many).select(*fact.columns, *take)

    return split


def asof_join_split(
    fact: DataFrame, dim: DataFrame, key: str, date_col: str, take: list[str], long_history: int = LONG_HISTORY
) -> DataFrame:
    """Same result as ``asof_join``, each key by the form that suits it."""
    return choose_asof_join(dim, key, long_history)(fact, dim, key, date_col, take)
