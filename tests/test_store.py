"""Open versions in buckets: merged without moving the history."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martwright.operators.history import first_load, merge_open, scd2_merge
from martwright.plans.dimensions import TRACKED
from martwright.schemas import SOURCES, conform
from martwright.sources.store import Store

KEY = "policy_id"


def policies(spark, status, keys):
    return conform(spark.createDataFrame([(k, status(k)) for k in keys], "policy_id string, status string"), SOURCES["policies"])


def at(day):
    return datetime(2024, 1, 1, 2) + timedelta(days=day)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("buckets", [5, 8, 24])
def test_merge_moves_the_extract_only(spark, tmp_path, no_broadcast, buckets):
    store = Store(spark, str(tmp_path), buckets)
    first = policies(spark, lambda k: "Active", [None, *(f"p{i}" for i in range(300))])
    store.write_versions("r1", "policies", first_load(first, KEY, at(0)), KEY)
    second = policies(spark, lambda k: "Lapsed" if k and k.endswith("7") else "Active", [None, *(f"p{i}" for i in range(50, 330))])
    opened = store.open_versions("r1", "policies", KEY)
    merged = merge_open(opened, second, KEY, TRACKED["policies"], at(1))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\([^)]*, (\d+)\)", plan)
    assert exchanges == [str(buckets)], plan
    assert "Bucketed: true" in plan
    store.write_versions("r2", "policies", merged, KEY, "r1")
    expected = scd2_merge(first_load(first, KEY, at(0)), second, KEY, TRACKED["policies"], at(1))
    kept = spark.read.parquet(f"{tmp_path}/history/policies/run=r2").select(*expected.columns)
    assert sorted(map(str, kept.collect())) == sorted(map(str, expected.collect()))
    # Written as it was read: in buckets again, one file each and kind.
    assert store._open_folder("r2", "policies")[1] == buckets
    assert store.open_versions("r2", "policies", KEY).count() == store.open_versions("r2", "policies").count()


def test_number_of_buckets_is_kept_and_can_be_changed(spark, tmp_path):
    rows = first_load(policies(spark, lambda k: "Active", ["a", "b", "c"]), KEY, at(0))
    Store(spark, str(tmp_path), 3).write_versions("r1", "policies", rows, KEY)
    Store(spark, str(tmp_path)).write_versions("r2", "policies", rows, KEY, "r1")
    Store(spark, str(tmp_path), 7).write_versions("r3", "policies", rows, KEY, "r2")
    store = Store(spark, str(tmp_path))
    assert [store._open_folder(run, "policies")[1] for run in ("r1", "r2", "r3")] == [3, 3, 7]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("martwright_") and "open" not in t.name]
    # A run that is made again replaces what it had written, in other buckets too.
    Store(spark, str(tmp_path), 2).write_versions("r3", "policies", rows.limit(1), KEY)
    assert store._open_folder("r3", "policies")[1] == 2 and store.open_versions("r3", "policies").count() == 1


def test_without_open_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.open_versions("none", "policies", KEY).count() == 0
    closed = first_load(policies(spark, lambda k: "Active", ["a"]), KEY, at(0)).withColumn("dbt_valid_to", F.lit("2024-02-01").cast("timestamp_ntz"))
    store.write_versions("r1", "policies", closed, KEY)
    assert store.open_versions("r1", "policies", KEY).count() == 0
