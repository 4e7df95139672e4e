"""Day folders taken in by a stream: in any order, and after failures."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from martwright.operators.history import scd2_replay
from martwright.plans.dimensions import TRACKED
from martwright.plans.intake import Intake, at_two_next_day
from martwright.schemas import SOURCES, conform
from martwright.sources.landing import land

DAYS = [f"2024-01-{d:02}" for d in (3, 4, 6, 9, 15)]


def extract(spark, day):
    rng = random.Random(day)
    rows = [(f"p{i}", rng.choice(["Active", "Lapsed"]), f"A{rng.randrange(2)}") for i in range(60) if rng.random() < 0.7]
    rows.append((None, "Active", "A0"))
    return conform(spark.createDataFrame(rows, "policy_id string, status string, agent_id string"), SOURCES["policies"])


def expected(spark, days):
    all_days = [extract(spark, d).withColumn("run_ts", F.lit(at_two_next_day(d)).cast("timestamp_ntz")) for d in days]
    rows = all_days[0]
    for more in all_days[1:]:
        rows = rows.unionByName(more)
    return sorted(map(str, scd2_replay(rows, "policy_id", TRACKED["policies"], "run_ts").collect()))


def put(spark, root, days):
    for day in days:
        land(extract(spark, day).coalesce(1), f"{root}/raw", "policies", day)


def found(intake):
    return sorted(map(str, intake.history().collect()))


@pytest.mark.parametrize("waves", [[[0, 1, 2, 3, 4]], [[2], [0, 4], [3, 1]], [[4], [3], [2], [1], [0]]])
def test_any_order_of_folders_gives_the_same_history(spark, tmp_path, waves):
    intake = Intake(spark, str(tmp_path), "policies")
    for wave in waves:
        put(spark, str(tmp_path), [DAYS[i] for i in wave])
        intake.run(files_per_batch=1)
    assert found(intake) == expected(spark, DAYS)
    before = intake.taken().count()
    intake.run()  # nothing new
    assert intake.taken().count() == before == len(DAYS)


@pytest.mark.parametrize("after_write", [False, True])
def test_a_failure_between_days_changes_nothing(spark, tmp_path, monkeypatch, after_write):
    """The third day fails, before or after its versions are written; the stream is started again."""
    put(spark, str(tmp_path), DAYS[:4])
    intake, take, calls = Intake(spark, str(tmp_path), "policies"), Intake.take, []

    def failing(self, day):
        calls.append(day)
        if len(calls) == 3:
            if after_write:
                take(self, day)
            raise RuntimeError("lost")
        take(self, day)

    monkeypatch.setattr(Intake, "take", failing)
    with pytest.raises(StreamingQueryException):
        intake.run(files_per_batch=2)
    put(spark, str(tmp_path), DAYS[4:])
    if after_write:
        with pytest.warns(UserWarning, match="came again"):
            intake.run(files_per_batch=2)
    else:
        intake.run(files_per_batch=2)
    assert found(intake) == expected(spark, DAYS)


def test_versions_that_go_and_come_again(spark, tmp_path):
    """A late day takes a version in, a later one parts it again: what went isn't lost."""
    rows = {"2024-01-01": "Active", "2024-01-05": "Lapsed", "2024-01-03": "Lapsed", "2024-01-04": "Active"}
    intake, root = Intake(spark, str(tmp_path), "policies"), str(tmp_path)
    for day, status in rows.items():
        one = conform(spark.createDataFrame([("p", status, day)], "policy_id string, status string, branch string"), SOURCES["policies"])
        land(one, f"{root}/raw", "policies", day)
        intake.run()
    kept = intake.history().orderBy("dbt_valid_from").collect()
    assert [(r.status, r.branch, r.dbt_valid_to is None, r.is_first_version) for r in kept] == [
        ("Active", "2024-01-01", False, True),
        ("Lapsed", "2024-01-03", False, False),
        ("Active", "2024-01-04", False, False),
        ("Lapsed", "2024-01-05", True, False),
    ]
