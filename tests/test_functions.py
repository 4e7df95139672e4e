import hashlib
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from martwright.functions import audit, keys
from martwright.functions.frames import union_all
from martwright.plans.dimensions import dim_date


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None), ("b", datetime(2024, 1, 5, 2, 0, 0, 120000))], "k string, t timestamp_ntz")
    rows = [r[0] for r in df.orderBy("k").select(keys.surrogate_key("k", "t")).collect()]
    assert rows == [md5("a-_dbt_utils_surrogate_key_null_"), md5("b-2024-01-05 02:00:00.12")]


def test_version_id_takes_null_as_empty(spark):
    df = spark.createDataFrame([(None, datetime(2024, 1, 5))], "k string, t timestamp_ntz")
    assert df.select(keys.version_id("k", "t")).first()[0] == md5("|2024-01-05 00:00:00")


def test_any_distinct_is_never_null(spark):
    df = spark.createDataFrame([(1, 1), (None, None), (None, 1), (2, 1)], "a int, b int")
    differs = keys.any_distinct([(F.col("a"), F.col("b"))])
    assert [r[0] for r in df.select(differs).collect()] == [False, False, True, True]


def test_stamps_are_utc_and_run_stamp_has_whole_seconds(spark):
    ts = datetime(2024, 1, 31, 4, 0, 0, 999, tzinfo=timezone(timedelta(hours=2)))
    row = audit.with_loaded_at(spark.range(1).select(audit.run_stamp(ts)), ts).first()
    assert row.dbt_run_started_at == datetime(2024, 1, 31, 2, 0, 0)
    assert row.etl_loaded_at == datetime(2024, 1, 31, 2, 0, 0, 999)


def test_calendar_against_python(spark):
    rows = {r.date_day: r for r in dim_date(spark, datetime(2024, 1, 1)).collect()}
    day, n = date(2020, 1, 1), 0
    while day < date(2048, 1, 1):
        r, n = rows[day], n + 1
        assert (r.year, r.quarter, r.month, r.day_of_month) == (day.year, (day.month + 2) // 3, day.month, day.day)
        assert (r.month_name, r.day_name) == (day.strftime("%B"), day.strftime("%A"))
        assert r.day_of_week == day.isoweekday() % 7
        assert r.is_weekend == (day.isoweekday() >= 6)
        day += timedelta(days=1)
    assert n == len(rows) == 10227


def test_union_all(spark):
    frames = [spark.range(i, i + 1) for i in range(5)]
    assert sorted(r[0] for r in union_all(frames).collect()) == [0, 1, 2, 3, 4]
