import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martwright.operators.asof import asof_join, asof_join_by_day, asof_join_split, choose_asof_join

DIM = "k string, sk string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def versions(spark, rows):
    return spark.createDataFrame(rows, DIM)


def facts(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, day date")


@pytest.fixture(scope="module")
def two(spark):
    change = datetime(2024, 1, 5, 2)
    return versions(
        spark, [("x", "old", datetime(1900, 1, 1), change), ("x", "new", change, datetime(9999, 12, 31))]
    )


@pytest.mark.parametrize("join", [asof_join, asof_join_by_day])
def test_day_of_a_change_gets_the_old_version(spark, two, join):
    rows = facts(spark, [(1, "x", date(2024, 1, 4)), (2, "x", date(2024, 1, 5)), (3, "x", date(2024, 1, 6)), (4, "y", date(2024, 1, 6)), (5, None, date(2024, 1, 6)), (6, "x", None)])
    found = {r.id: r.sk for r in join(rows, two, "k", "day", ["sk"]).collect()}
    assert found == {1: "old", 2: "old", 3: "new", 4: None, 5: None, 6: None}


@pytest.mark.parametrize("join", [asof_join, asof_join_by_day])
def test_interval_is_half_open(spark, join):
    dim = versions(spark, [("x", "a", datetime(2024, 1, 2), datetime(2024, 1, 3)), ("x", "b", datetime(2024, 1, 3), datetime(2024, 1, 4))])
    rows = facts(spark, [(1, "x", date(2024, 1, 2)), (2, "x", date(2024, 1, 3)), (3, "x", date(2024, 1, 4)), (4, "x", date(2024, 1, 1))])
    found = {r.id: r.sk for r in join(rows, dim, "k", "day", ["sk"]).collect()}
    assert found == {1: "a", 2: "b", 3: None, 4: None}


def test_both_joins_agree_on_a_hot_key_and_overlapping_versions(spark):
    rng = random.Random(7)
    start = datetime(2024, 1, 1, 2)
    dim_rows = [("hot", "first", datetime(1900, 1, 1), start)]
    dim_rows += [("hot", f"v{i}", start + timedelta(days=i), start + timedelta(days=i + 1)) for i in range(60)]
    dim_rows += [("hot", "twice", start + timedelta(days=9), start + timedelta(days=12))]
    dim_rows += [(f"k{i}", f"s{i}", datetime(1900, 1, 1), datetime(9999, 12, 31)) for i in range(50)]
    fact_rows = [
        (i, "hot" if i % 3 == 0 else f"k{rng.randrange(60)}", date(2023, 12, 25) + timedelta(days=rng.randrange(90)))
        for i in range(3000)
    ]
    dim, rows = versions(spark, dim_rows), facts(spark, fact_rows)
    one = sorted((r.id, r.k, r.sk or "") for r in asof_join(rows, dim, "k", "day", ["sk"]).collect())
    other = sorted((r.id, r.k, r.sk or "") for r in asof_join_by_day(rows, dim, "k", "day", ["sk"]).collect())
    assert one == other and len(one) > 3000
    expected = sorted(
        (i, k, sk)
        for i, k, day in fact_rows
        for sk in [v[1] for v in dim_rows if v[0] == k and v[2] <= datetime.combine(day, datetime.min.time()) < v[3]] or [""]
    )
    assert one == expected


def test_large_sides_are_merged_by_key_not_broadcast_or_nested(spark, two):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = asof_join(facts(spark, [(1, "x", date(2024, 1, 4))]), two, "k", "day", ["sk"])
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "NestedLoop" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def scaled(spark):
    """Thresholds of AQE scaled to the test: no broadcast by size, skew from 64 kB on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_facts(spark):
    """A third has one key."""
    return spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 60).cast("int")).alias("day"),
    )


def hot_versions(spark, long: int):
    """One version per key, and one key with ``long`` of them."""
    keys = [(k, k, datetime(1900, 1, 1), datetime(9999, 12, 31)) for k in ["hot", *(f"k{i}" for i in range(500))]]
    begin = datetime(1900, 1, 1)
    keys += [("long", f"v{i}", begin + timedelta(days=i), begin + timedelta(days=i + 1)) for i in range(long)]
    return versions(spark, keys)


def test_aqe_splits_a_hot_key_of_the_fact_side(spark, scaled):
    joined = asof_join(hot_facts(spark), hot_versions(spark, 0), "k", "day", ["sk"])
    assert len(joined.collect()) == 200_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("long", [0, 30])
def test_hot_keys_are_split_whatever_histories_other_keys_have(spark, scaled, long):
    dim = hot_versions(spark, long)
    joined = asof_join_split(hot_facts(spark), dim, "k", "day", ["sk"], long_history=20)
    assert joined.filter("sk = k").count() == 200_000
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_with_long_histories_are_split_by_day(spark, scaled):
    """All keys are long, more than may be broadcast: facts are joined by key and day."""
    dim = hot_versions(spark, 0)
    resolve = choose_asof_join(dim, "k", long_history=0, most_long=100)
    assert resolve is asof_join_by_day
    joined = resolve(hot_facts(spark), dim, "k", "day", ["sk"])
    assert joined.filter("sk = k").count() == 200_000


@pytest.mark.parametrize("long_history", [0, 1, 2, 500])
def test_keys_with_long_histories_are_joined_apart(spark, two, long_history):
    dim = two.unionByName(versions(spark, [("z", "only", datetime(1900, 1, 1), datetime(9999, 12, 31))]))
    rows = facts(spark, [(1, "x", date(2024, 1, 5)), (2, "x", date(2024, 1, 6)), (3, "z", date(2024, 1, 6)), (4, "y", date(2024, 1, 6)), (5, None, date(2024, 1, 6)), (6, "x", None)])
    joined = asof_join_split(rows, dim, "k", "day", ["sk"], long_history)
    assert joined.columns == ["id", "k", "day", "sk"]
    assert {r.id: r.sk for r in joined.collect()} == {1: "old", 2: "new", 3: "only", 4: None, 5: None, 6: None}
    assert asof_join_split(rows, dim.limit(0), "k", "day", ["sk"]).filter("sk is null").count() == 6
