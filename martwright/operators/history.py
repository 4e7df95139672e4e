"""Type 2 history: versions of a key, closed and opened as tracked columns change.

A history has the columns of its source and ``HISTORY_COLUMNS``. A version is open while
``dbt_valid_to`` is NULL; a key has one open version. Rows of one key in a history are at
most the runs that were made, because a run adds at most one version per key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions.audit import timestamp
from martwright.functions.keys import any_distinct, version_id
from martwright.schemas import FIRST_VERSION, VALID_FROM, VALID_TO, VERSION_ID


class DuplicateKeyError(ValueError):
    """An extract holds a key more than once, so no single version can be made from it."""


def assert_unique_key(staged: DataFrame, key: str) -> None:
    """Raise, naming some of the keys, if ``staged`` holds a key twice."""
    twice = staged.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    found = [row[0] for row in twice.limit(10).collect()]
    if found:
        raise DuplicateKeyError(f"duplicate {key} in extract: {', '.join(map(str, found))}")


def first_load(staged: DataFrame, key: str, run_ts: datetime | Column) -> DataFrame:
    """History after the first run: every row opens a first version."""
    return staged.select(*staged.columns, *_opened(F.col(key), timestamp(run_ts), first=True))


def merge_open(
    open_versions: DataFrame, staged: DataFrame, key: str, check_cols: list[str], run_ts: datetime | Column
) -> DataFrame:
    """What becomes of the open versions when ``staged`` arrives.

    Unchanged, or absent from the extract: the version stays as it is, its untracked columns
    included. A tracked column changed: the version is closed at ``run_ts`` and a new one
    opened. A new key: a first version is opened. One full outer join; each joined pair gives
    its one or two versions in place, so the join isn't repeated per case. A NULL key matches
    nothing: its open versions stay and its staged rows open first ones. Such rows go around the
    join, where they would all meet in one task. The key is joined as a column of its own, so open versions
    that are stored in buckets by key are read where they are, and only ``staged`` is shuffled.
    """
    keyless = open_versions.filter(F.col(key).isNull()), staged.filter(F.col(key).isNull())
    open_versions, staged = (df.filter(F.col(key).isNotNull()) for df in (open_versions, staged))
    now, attrs = timestamp(run_ts), staged.columns
    columns = [*attrs, VALID_FROM, VALID_TO, VERSION_ID, FIRST_VERSION]
    old = open_versions.select(F.col(key).alias("__old"), F.struct(*columns).alias("old"))
    new = staged.select(F.col(key).alias("__new"), F.struct(*attrs).alias("new"))
    pairs = old.join(new, F.col("__old") == F.col("__new"), "full_outer")

    def opened(first: bool) -> Column:
        return F.struct(*[F.col(f"new.{c}").alias(c) for c in attrs], *_opened(F.col(f"new.{key}"), now, first))

    closed = F.struct(*[now.alias(c) if c == VALID_TO else F.col(f"old.{c}").alias(c) for c in columns])
    changed = any_distinct((F.col(f"old.{c}"), F.col(f"new.{c}")) for c in check_cols)
    versions = (
        F.when(F.col("old").isNull(), F.array(opened(first=True)))
        .when(F.col("new").isNull() | ~changed, F.array(F.col("old")))
        .otherwise(F.array(closed, opened(first=False)))
    )
    merged = pairs.select(F.inline(versions)).unionByName(keyless[0].select(*columns))
    return merged.unionByName(first_load(keyless[1], key, run_ts))


def scd2_merge(
    history: DataFrame, staged: DataFrame, key: str, check_cols: list[str], run_ts: datetime | Column
) -> DataFrame:
    """``history`` after ``staged`` was merged at ``run_ts``. Closed versions pass through."""
    if FIRST_VERSION not in history.columns:
        history = mark_first(history, key)
    still_open = history.filter(F.col(VALID_TO).isNull())
    merged = merge_open(still_open, staged, key, check_cols, run_ts)
    return history.filter(F.col(VALID_TO).isNotNull()).unionByName(merged)


def scd2_replay(extracts: DataFrame, key: str, check_cols: list[str], run_ts: str) -> DataFrame:
    """History that merging each extract in turn would give, in one pass.

    ``run_ts`` names the column with the time of the run an extract row belongs to; a key
    occurs once per run, which is checked on the way. Both window steps and the check share
    one shuffle and one sort by key and time. As in the merge, every row with a NULL key opens a
    first version that nothing closes, and stays out of the windows.
    """
    keyless = extracts.filter(F.col(key).isNull())
    extracts = extracts.filter(F.col(key).isNotNull())
    by_time = Window.partitionBy(key).orderBy(run_ts)
    previous = [F.lag(c).over(by_time).alias(f"__previous_{c}") for c in (run_ts, *check_cols)]
    attrs = [c for c in extracts.columns if c != run_ts]
    seen = extracts.select("*", *previous)
    before = F.col(f"__previous_{run_ts}")
    changed = any_distinct((F.col(c), F.col(f"__previous_{c}")) for c in check_cols)
    twice = F.raise_error(F.concat(F.lit(f"duplicate {key} in extract: "), F.col(key).cast("string")))
    kept = seen.filter(F.when(before == F.col(run_ts), twice.cast("boolean")).otherwise(before.isNull() | changed))
    replayed = kept.select(
        *attrs,
        F.col(run_ts).alias(VALID_FROM),
        F.lead(run_ts).over(by_time).alias(VALID_TO),
        version_id(key, run_ts).alias(VERSION_ID),
        before.isNull().alias(FIRST_VERSION),
    )
    return replayed.unionByName(keyless.select(*attrs, *_opened(F.col(key), F.col(run_ts), first=True)))


def next_seen(extracts: DataFrame, late: DataFrame, key: str, run_ts: str, at: datetime | Column) -> DataFrame:
    """Of the keys in ``late``, the first row that an extract after ``at`` has of each, with its ``run_ts``.

    ``extracts`` has the rows of all extracts that the history took, ``run_ts`` the time of their run."""
    after = extracts.filter(F.col(run_ts) > timestamp(at)).join(late.select(key), key, "left_semi")
    columns = [c for c in extracts.columns if c not in (key, run_ts)]
    first = after.groupBy(key).agg(F.min(F.struct(run_ts, *columns)).alias("first"))
    return first.select(key, "first.*").select(*extracts.columns)


def splice_changes(
    history: DataFrame, late: DataFrame, following: DataFrame, key: str, check_cols: list[str], at: datetime | Column
) -> DataFrame:
    """What an extract that comes late, of a run at ``at``, does to ``history``: versions with ``removed``, which
    is true for those that go and false for those that come. A version that is altered goes and comes again.

    ``following`` is ``next_seen`` of the extract, with its time as ``run_ts``. A row that differs from the
    version in effect opens one at ``at``, until the next extract that has the key: there the former version
    goes on as a new one, unless that extract changed the key anyway. If its version then equals the late row,
    the two are one. A key's earliest row opens its first version. So at most the version in effect and the one
    after it are touched; those two are found by one aggregate over the versions of the keys in ``late``.
    """
    now, attrs = timestamp(at), late.columns
    columns = [*attrs, VALID_FROM, VALID_TO, VERSION_ID, FIRST_VERSION]
    keyless = late.filter(F.col(key).isNull())
    late = late.filter(F.col(key).isNotNull())
    mine = history.select(*columns).join(late.select(key), key, "left_semi")
    version = F.struct(F.col(VALID_FROM).alias("since"), F.struct(*columns).alias("row"))
    upto = F.col(VALID_FROM) <= now
    around = mine.groupBy(F.col(key).alias("__key")).agg(
        F.max(F.when(upto, version)).alias("here"), F.min(F.when(~upto, version)).alias("then")
    )
    seen = following.select(F.col(key).alias("__seen"), F.struct("run_ts", *attrs).alias("seen"))
    placed = (
        late.select(F.struct(*attrs).alias("late"))
        .join(around, F.col(f"late.{key}") == F.col("__key"), "left")
        .join(seen, F.col(f"late.{key}") == F.col("__seen"), "left")
        .select("late", "seen", F.col("here.row").alias("here"), F.col("then.row").alias("then"))
    )
    twice = F.raise_error(F.concat(F.lit(f"{key} already has a version of that time: "), F.col(f"late.{key}").cast("string")))
    placed = placed.filter(F.when(F.col(f"here.{VALID_FROM}") == now, twice.cast("boolean")).otherwise(F.lit(True)))

    def differ(a: str, b: str) -> Column:
        return any_distinct((F.col(f"{a}.{c}"), F.col(f"{b}.{c}")) for c in check_cols)

    def version_of(attributes: str, since: Column, until: Column, first: Column, removed: bool = False) -> Column:
        values = {c: F.col(f"{attributes}.{c}") for c in attrs}
        values |= {VALID_FROM: since, VALID_TO: until.cast("timestamp_ntz"), VERSION_ID: version_id(F.col(f"{attributes}.{key}"), since)}
        values |= {FIRST_VERSION: first, "removed": F.lit(removed)}
        return F.struct(*[value.alias(name) for name, value in values.items()])

    def as_is(which: str, removed: bool, **instead: Column) -> Column:
        values = {c: instead.get(c, F.col(f"{which}.{c}")) for c in columns} | {"removed": F.lit(removed)}
        return F.struct(*[value.alias(name) for name, value in values.items()])

    no, opens, goes_on = F.lit(False), F.col("here").isNull(), F.col("seen.run_ts")
    closed = as_is("here", False, **{VALID_TO: now})
    # Up to the next version, which the late row takes in if it is the same.
    then_since, then_until = F.col(f"then.{VALID_FROM}"), F.col(f"then.{VALID_TO}")
    taken_in = F.array(as_is("then", True), version_of("late", now, then_until, opens))
    later = as_is("then", False, **{FIRST_VERSION: no})
    reaches = F.when(
        opens, F.array(as_is("then", True), version_of("late", now, then_since, opens), later)
    ).otherwise(F.array(version_of("late", now, then_since, opens)))
    upto_then = F.when(differ("late", "then"), reaches).otherwise(taken_in)
    # In the middle of a version: it goes on where the key is seen again.
    resumed = F.array(
        version_of("late", now, goes_on, opens), version_of("seen", goes_on, F.col(f"here.{VALID_TO}"), no)
    )
    alone = F.array(version_of("late", now, F.lit(None), opens))
    replaced = (
        F.when(goes_on.isNull(), alone).when(F.col("then").isNotNull() & (goes_on == then_since), upto_then).otherwise(resumed)
    )
    nothing = F.filter(alone, lambda _: no)
    changes = F.when(opens, replaced).when(
        differ("late", "here"), F.concat(F.array(as_is("here", True), closed), replaced)
    )
    found = placed.select(F.inline(F.coalesce(changes, nothing)))
    return found.unionByName(first_load(keyless, key, at).withColumn("removed", no))


def scd2_splice(
    history: DataFrame, late: DataFrame, following: DataFrame, key: str, check_cols: list[str], at: datetime | Column
) -> DataFrame:
    """``history`` as if the extract ``late`` had been merged in its turn, at ``at``; see ``splice_changes``.

    Versions that aren't touched pass through an anti join on their id."""
    if FIRST_VERSION not in history.columns:
        history = mark_first(history, key)
    changes = splice_changes(history, late, following, key, check_cols, at)
    gone = changes.filter("removed").select(F.col(key).alias("__key"), F.col(VALID_FROM).alias("__from"))
    kept = history.join(gone, (F.col(key) == F.col("__key")) & (F.col(VALID_FROM) == F.col("__from")), "left_anti")
    return kept.unionByName(changes.filter("NOT removed").select(*history.columns))


def mark_first(history: DataFrame, key: str) -> DataFrame:
    """Add ``is_first_version`` to a history that came without it.

    An aggregate joined back rather than a numbering window: the aggregate is combined before its shuffle,
    and the join can be split if one key holds a large share of the rows. For that both its sides must come
    from shuffles of its own, so the aggregate is dealt anew.
    """
    earliest = (
        history.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.min(F.struct(VALID_FROM, VERSION_ID)).alias("__first"))
        .repartition("__first")
    )
    found = history.join(earliest, F.col(key) == F.col("__key"), "left")
    is_first = F.coalesce(F.struct(VALID_FROM, VERSION_ID) == F.col("__first"), F.lit(True))
    return found.withColumn(FIRST_VERSION, is_first).drop("__key", "__first")


def _opened(key: Column, now: Column, first: bool) -> list[Column]:
    return [
        now.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        version_id(key, now).alias(VERSION_ID),
        F.lit(first).alias(FIRST_VERSION),
    ]
