"""Facts refreshed by part equal facts built anew, and only what is touched is written again."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martwright.functions.audit import timestamp
from martwright.operators.history import first_load, merge_open
from martwright.plans import increments
from martwright.plans.dimensions import TRACKED, dim_policies
from martwright.plans.facts import build_fact
from martwright.plans.increments import part_digests, part_of, refresh_fact, written_rows
from martwright.schemas import SOURCES, VALID_FROM, conform
from martwright.sources.store import LARGE_PART, Store

MART = "fct_claims"


def policies(spark, rows):
    df = spark.createDataFrame(rows, "policy_id string, status string")
    return conform(df, SOURCES["policies"])


def claims(spark, rows):
    return conform(spark.createDataFrame(rows, "claim_id string, policy_id string, claim_date date, status string"), SOURCES["claims"])


def take(store, run, last, staged, facts, run_ts):
    """What a daily run does for one fact."""
    if last:
        versions = merge_open(store.open_versions(last, "policies", "policy_id"), staged, "policy_id", TRACKED["policies"], run_ts)
    else:
        versions = first_load(staged, "policy_id", run_ts)
    store.write_versions(run, "policies", versions, "policy_id", last)
    store.commit(run_ts, run_ts, {})
    dim = dim_policies(store.history(run, "policies"), run_ts)
    opened = store.open_versions(run, "policies").filter(F.col(VALID_FROM) == timestamp(run_ts))
    refresh_fact(store, run, last, MART, facts, dim, opened, run_ts)
    found, full = store.mart(run, MART), build_fact(MART, facts, dim, run_ts)
    assert found.schema.names == full.schema.names
    assert sorted(map(str, found.collect())) == sorted(map(str, full.collect()))
    row = written_rows(store, run).filter(F.col("mart") == MART).first()
    return row.parts, row.parts_written, row["rows"], row.rows_written


def run_at(day):
    return datetime(2024, 1, 1, 2) + timedelta(days=day)


def test_only_touched_months_are_written_again(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    runs = {d: store.run_id(run_at(d)) for d in (0, 40, 41, 42, 43, 44, 45)}
    facts = [(f"c{i}", f"p{i % 5}", date(2023, 1 + i % 12, 3), "s") for i in range(60)] + [("new", "p9", date(2023, 5, 5), "s"), ("none", "p1", None, "s")]
    known = [(f"p{i}", "Active") for i in range(5)]
    done = take(store, runs[0], None, policies(spark, known), claims(spark, facts), run_at(0))
    assert done == (13, 13, 62, 62)
    # Nothing new.
    assert take(store, runs[40], runs[0], policies(spark, known), claims(spark, facts), run_at(40)) == (13, 0, 62, 0)
    # A new month, and a row of an old one that changed.
    facts = [("late", "p1", date(2024, 2, 11), "s"), *facts[:-2], ("new", "p9", date(2023, 5, 5), "other"), facts[-1]]
    assert take(store, runs[41], runs[40], policies(spark, known), claims(spark, facts), run_at(41)) == (14, 2, 63, 7)
    # A version opened on 2024-02-12 touches facts from then on only; there are none.
    changed = [("p1", "Lapsed"), *known[:1], *known[2:]]
    assert take(store, runs[42], runs[41], policies(spark, changed), claims(spark, facts), run_at(42)) == (14, 0, 63, 0)
    # A key that appears touches all its facts, which had no version.
    assert take(store, runs[43], runs[42], policies(spark, [*changed, ("p9", "Active")]), claims(spark, facts), run_at(43)) == (14, 1, 63, 6)
    # Facts of the day after the next change are resolved to the version it opens.
    facts = [*facts, ("next", "p1", date(2024, 2, 14), "s")]
    assert take(store, runs[44], runs[43], policies(spark, [("p1", "Active"), *changed[1:]]), claims(spark, facts), run_at(44))[1] == 1
    # A month that goes away, and rows that go.
    facts = [f for f in facts if f[2] != date(2023, 7, 3) and f[0] != "c2"]
    parts, written, rows, _ = take(store, runs[45], runs[44], policies(spark, changed), claims(spark, facts), run_at(45))
    assert (parts, rows) == (13, len(facts)) and written == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_three_random_runs_equal_full_builds(spark, tmp_path, seed):
    rng, store, last = random.Random(seed), Store(spark, str(tmp_path)), None
    facts: dict = {}
    for day in (0, 20, 50):
        for _ in range(80):
            name = f"c{rng.randrange(150)}"
            facts[name] = (name, rng.choice([f"p{rng.randrange(25)}", None]), date(2023, 11, 20) + timedelta(days=rng.randrange(60 + day)), "s")
        staged = [(f"p{i}", rng.choice(["Active", "Lapsed"])) for i in range(25) if rng.random() < 0.7]
        run = store.run_id(run_at(day))
        take(store, run, last, policies(spark, staged), claims(spark, list(facts.values())), run_at(day))
        last = run


def test_digests_see_every_change_but_not_the_order(spark):
    rows = [("a", "p", date(2024, 1, 1), "s"), ("a", "p", date(2024, 1, 1), "s"), ("b", None, date(2024, 1, 9), None)]
    digest = lambda r: {tuple(x) for x in part_digests(claims(spark, r), part_of("claim_date")).collect()}
    base = digest(rows)
    assert digest(rows[::-1]) == base
    for other in (rows[:2], [*rows, rows[0]], [rows[0], ("a", "p", date(2024, 1, 2), "s"), rows[2]], [rows[0], rows[1], ("b", None, date(2024, 1, 9), "")]):
        assert digest(other) != base


def test_empty_facts(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    none = claims(spark, []).limit(0)
    assert take(store, store.run_id(run_at(0)), None, policies(spark, [("p", "Active")]), none, run_at(0)) == (0, 0, 0, 0)


def test_digests_are_the_same_by_date_first(spark):
    rows = [(f"c{i}", f"p{i % 3}", date(2024, 1 + i % 2, 1 + i % 9) if i % 5 else None, "s") for i in range(50)]
    staged, part = claims(spark, rows), part_of("claim_date")
    by_date = part_digests(staged, part, "claim_date")
    assert sorted(map(tuple, by_date.collect())) == sorted(map(tuple, part_digests(staged, part).collect()))


def test_versions_are_joined_only_if_a_part_may_be_kept(spark, tmp_path, monkeypatch):
    def joined(*_):
        raise AssertionError("no part is as it was")

    monkeypatch.setattr(increments, "touched_parts", joined)
    store, known = Store(spark, str(tmp_path)), policies(spark, [("p0", "Active"), ("p1", "Active")])
    facts = [(f"c{i}", f"p{i % 2}", date(2023, 1 + i % 3, 3), "s") for i in range(12)]
    runs = [store.run_id(run_at(d)) for d in (0, 1)]
    assert take(store, runs[0], None, known, claims(spark, facts), run_at(0)) == (3, 3, 12, 12)
    other = [(*f[:3], "other") for f in facts]
    assert take(store, runs[1], runs[0], known, claims(spark, other), run_at(1)) == (3, 3, 12, 12)


def test_rows_of_large_parts_are_not_moved(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    rows = claims(spark, [(f"c{i}", "p", date(2024, 1 + i % 2, 1), "s") for i in range(40)]).repartition(4)
    df = rows.withColumn("part", part_of("claim_date"))
    files = lambda run: [len(list(p.glob("*.parquet"))) for p in (tmp_path / "marts" / f"run={run}" / MART).glob("part=*")]
    assert store.write_fact("small", MART, df, LARGE_PART - 1) == 40 and files("small") == [1, 1]
    assert store.write_fact("large", MART, df, LARGE_PART) == 40 and files("large") == [4, 4]
    kept = [spark.read.parquet(f"{tmp_path}/marts/run={run}/{MART}").collect() for run in ("small", "large")]
    assert sorted(map(str, kept[0])) == sorted(map(str, kept[1]))
