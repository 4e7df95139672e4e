import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from martwright.operators.history import (
    DuplicateKeyError,
    assert_unique_key,
    first_load,
    mark_first,
    merge_open,
    next_seen,
    scd2_merge,
    scd2_replay,
    scd2_splice,
    splice_changes,
)
from martwright.plans.dimensions import type2_dimension

STAGED = "k string, status string, amount int, note string"
T0 = datetime(2024, 1, 1, 2)


def at(day):
    return T0 + timedelta(days=day)


def staged(spark, rows):
    return spark.createDataFrame(rows, STAGED)


def by_hand(extracts):
    """The merge rules, one row after the other."""
    versions = []
    for day, rows in extracts:
        for k, status, amount, note in rows:
            current = next((v for v in versions if v["k"] == k and v["to"] is None), None)
            if current and (current["status"], current["amount"]) == (status, amount):
                continue
            if current:
                current["to"] = at(day)
            versions.append(
                {"k": k, "status": status, "amount": amount, "note": note, "from": at(day), "to": None, "first": not current}
            )
    return sorted((v["k"], v["from"], v["to"] or datetime.max, v["status"] or "", v["amount"] or -1, v["note"], v["first"]) for v in versions)


def collected(history):
    return sorted(
        (r.k or "", r.dbt_valid_from, r.dbt_valid_to or datetime.max, r.status or "", r.amount or -1, r.note, r.is_first_version)
        for r in history.collect()
    )


def merged(spark, extracts):
    (day, rows), *later = extracts
    history = first_load(staged(spark, rows), "k", at(day))
    for day, rows in later:
        history = scd2_merge(history, staged(spark, rows), "k", ["status", "amount"], at(day))
    return history


def replayed(spark, extracts):
    rows = [(*row, at(day)) for day, day_rows in extracts for row in day_rows]
    df = spark.createDataFrame(rows, f"{STAGED}, run_ts timestamp_ntz")
    return scd2_replay(df, "k", ["status", "amount"], "run_ts")


@pytest.mark.parametrize("seed", range(4))
def test_merge_and_replay_follow_the_rules(spark, seed):
    rng = random.Random(seed)
    extracts = []
    for day in range(6):
        keys = [f"k{i}" for i in range(6) if rng.random() < 0.7] or ["k0"]
        extracts.append(
            (day, [(k, rng.choice(["a", "b", None]), rng.choice([1, None]), f"{k}@{day}") for k in keys])
        )
    expected = by_hand(extracts)
    assert collected(merged(spark, extracts)) == expected
    assert collected(replayed(spark, extracts)) == expected


def test_value_null_value_gives_three_versions(spark):
    extracts = [(0, [("x", "a", 1, "")]), (1, [("x", None, 1, "")]), (2, [("x", "a", 1, "")])]
    assert merged(spark, extracts).count() == replayed(spark, extracts).count() == 3


def test_untracked_columns_stay_as_recorded(spark):
    extracts = [(0, [("x", "a", 1, "old")]), (1, [("x", "a", 1, "new")])]
    rows = merged(spark, extracts).collect()
    assert [(r.note, r.dbt_valid_to) for r in rows] == [("old", None)]


def test_absent_key_stays_current(spark):
    extracts = [(0, [("x", "a", 1, ""), ("y", "a", 1, "")]), (1, [("y", "b", 1, "")])]
    rows = merged(spark, extracts).filter("k = 'x'").collect()
    assert [r.dbt_valid_to for r in rows] == [None]


def test_same_extract_again_changes_nothing(spark):
    extracts = [(0, [("x", "a", 1, "")]), (1, [("x", "b", 1, "")])]
    again = [*extracts, (2, [("x", "b", 1, "")])]
    assert collected(merged(spark, extracts)) == collected(merged(spark, again))


def test_duplicate_keys_are_named(spark):
    rows = [("x", "a", 1, ""), ("x", "b", 1, ""), ("y", "a", 1, "")]
    with pytest.raises(DuplicateKeyError, match="k in extract: x"):
        assert_unique_key(staged(spark, rows), "k")
    with pytest.raises(SparkRuntimeException, match="duplicate k in extract: x"):
        replayed(spark, [(0, rows)]).collect()


def test_first_version_found_afterwards(spark):
    extracts = [(0, [("x", "a", 1, "")]), (1, [("x", "b", 1, ""), ("y", "a", 1, "")]), (2, [("x", "c", 1, "")])]
    history = replayed(spark, extracts)
    assert collected(mark_first(history.drop("is_first_version"), "k")) == collected(history)


def test_dimension_reaches_back_and_overwrites(spark):
    extracts = [(0, [("x", "a", 1, "old"), ("y", "a", 1, "old")]), (1, [("x", "b", 1, "mid")])]
    current = staged(spark, [("x", "b", 1, "new")])
    dim = type2_dimension(replayed(spark, extracts), "k", "sk", at(9), current, ["note"])
    rows = {(r.k, r.status): r for r in dim.collect()}
    assert rows["x", "a"].valid_from == datetime(1900, 1, 1)
    assert rows["x", "a"].valid_to == rows["x", "b"].valid_from == at(1)
    assert rows["x", "b"].valid_to == datetime(9999, 12, 31) and rows["x", "b"].is_current
    assert {rows["x", "a"].note, rows["x", "b"].note} == {"new"}
    assert rows["y", "a"].note is None  # absent from the latest extract
    hashed = replayed(spark, extracts).select(F.md5(F.concat_ws("-", "k", F.col("dbt_valid_from").cast("string"))))
    assert {r[0] for r in hashed.collect()} == {r.sk for r in rows.values()}  # the time before the sentinel


def test_dimension_without_the_flag(spark):
    extracts = [(0, [("x", "a", 1, "")]), (1, [("x", "b", 1, "")])]
    history = replayed(spark, extracts)
    with_flag = type2_dimension(history, "k", "sk", at(9)).drop("is_first_version")
    without = type2_dimension(history.drop("is_first_version"), "k", "sk", at(9)).select(*with_flag.columns)
    assert sorted(map(tuple, with_flag.drop("dbt_valid_to").collect())) == sorted(
        map(tuple, without.drop("is_first_version", "dbt_valid_to").collect())
    )


def test_replay_equals_merge_with_null_keys(spark):
    rng = random.Random(7)
    extracts = []
    for day in range(4):
        rows = [(k, rng.choice("ab"), rng.randint(1, 2), "") for k in "xyz" if rng.random() < 0.8]
        extracts.append((day, rows + [(None, rng.choice("ab"), 1, "") for _ in range(rng.randint(0, 2))]))
    merged = first_load(staged(spark, extracts[0][1]), "k", at(0))
    for day, rows in extracts[1:]:
        merged = scd2_merge(merged, staged(spark, rows), "k", ["status", "amount"], at(day))
    again = replayed(spark, extracts)
    assert collected(merged.select(*again.columns)) == collected(again)
    assert again.filter("k is null").count() == sum(r[0] is None for _, rows in extracts for r in rows)


def test_null_keys_stay_out_of_the_joins(spark):
    rows = staged(spark, [("x", "a", 1, ""), (None, "a", 1, "")])
    plan = merge_open(first_load(rows, "k", at(0)), rows, "k", ["status"], at(1))._jdf.queryExecution().optimizedPlan()
    sides = [line for line in plan.toString().split("\n") if "Filter" in line]
    assert any("isnotnull" in line for line in sides)


LATE = "k string, status string, note string"


def late_extracts(seed, days=6, keys=150):
    rng = random.Random(seed)
    return {
        d: [(f"k{i}", rng.choice(["a", "b", None]), f"n{d}") for i in range(keys) if rng.random() < 0.6]
        + ([(None, "x", f"n{d}")] if d % 3 == 0 else [])
        for d in range(days)
    }


@pytest.mark.parametrize("order", [[5, 4, 3, 2, 1, 0], [2, 0, 5, 1, 4, 3], [0, 3, 1, 2, 5, 4]])
def test_extracts_in_any_order_give_the_history_of_the_replay(spark, order, tmp_path):
    extracts, done, history = late_extracts(sum(order[:3])), [], None

    def all_of(days):
        rows = [(*r, at(d + 1)) for d in days for r in extracts[d]]
        return spark.createDataFrame(rows, f"{LATE}, run_ts timestamp_ntz")

    for n, d in enumerate(order):
        day = spark.createDataFrame(extracts[d], LATE)
        if history is None:
            history = first_load(day, "k", at(d + 1))
        elif d > max(done):
            history = scd2_merge(history, day, "k", ["status"], at(d + 1))
        else:
            following = next_seen(all_of(done), day, "k", "run_ts", at(d + 1))
            history = scd2_splice(history, day, following, "k", ["status"], at(d + 1))
        history.write.parquet(f"{tmp_path}/{n}")
        history = spark.read.parquet(f"{tmp_path}/{n}")
        done.append(d)
    expected = scd2_replay(all_of(range(len(extracts))), "k", ["status"], "run_ts")
    assert sorted(map(str, history.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_a_late_extract_touches_neighbouring_versions_only(spark):
    rows = [("x", "a", "1", at(1)), ("x", "b", "2", at(3)), ("x", "a", "3", at(9)), ("y", "a", "4", at(1))]
    extracts = spark.createDataFrame(rows, f"{LATE}, run_ts timestamp_ntz")
    history = scd2_replay(extracts, "k", ["status"], "run_ts")
    late = spark.createDataFrame([("x", "c", "late")], LATE)
    following = next_seen(extracts, late, "k", "run_ts", at(2))
    changes = splice_changes(history, late, following, "k", ["status"], at(2)).collect()
    assert sorted((r.removed, r.status, r.dbt_valid_from, r.dbt_valid_to) for r in changes) == [
        (False, "a", at(1), at(2)),
        (False, "c", at(2), at(3)),
        (True, "a", at(1), at(3)),
    ]
    same = spark.createDataFrame([("x", "b", "late"), ("y", "a", "late")], LATE)
    following = next_seen(extracts, same, "k", "run_ts", at(4))
    assert splice_changes(history, same, following, "k", ["status"], at(4)).count() == 0


def test_an_extract_of_a_time_that_has_versions_is_refused(spark):
    extracts = spark.createDataFrame([("x", "a", "1", at(1))], f"{LATE}, run_ts timestamp_ntz")
    history, late = scd2_replay(extracts, "k", ["status"], "run_ts"), spark.createDataFrame([("x", "b", "2")], LATE)
    with pytest.raises(Exception, match="already has a version"):
        scd2_splice(history, late, next_seen(extracts, late, "k", "run_ts", at(1)), "k", ["status"], at(1)).collect()


def test_first_versions_are_found_with_a_join_that_can_be_split(spark):
    scaled = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    before = {name: spark.conf.get(name, None) for name in scaled}
    for name, value in scaled.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500))
        since = F.timestamp_seconds(F.col("id")).cast("timestamp_ntz")
        rows = spark.range(0, 200_000, 1, 8).select(key.alias("k"), since.alias("dbt_valid_from"), F.md5(F.col("id").cast("string")).alias("dbt_scd_id"))
        marked = mark_first(rows, "k")
        assert sum(r.is_first_version for r in marked.collect()) == 501
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
