import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from martwright.operators import quality as q
from martwright.plans.suite import GateError, _as_text, checks, count_violations, gate, summarize

DIM = "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
T0 = datetime(2024, 1, 1)


def dim(spark, rows):
    return spark.createDataFrame([(k, a, b, False) for k, a, b in rows], DIM)


def overlapped_by_hand(rows):
    """Versions the self join would report as the later one of a pair."""
    return {
        b for b in set(rows) for a in rows
        if a[0] is not None and a[0] == b[0] and a[1] < b[1] and a[1] < b[2] and a[2] > b[1]
    }


def gapped_by_hand(rows):
    found = set()
    for b in set(rows):
        earlier = [a[2] for a in rows if b[0] is not None and a[0] == b[0] and a[1] < min(b[1], b[2])]
        if earlier and max(earlier) < b[1]:
            found.add(b)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_overlap_and_gaps_against_a_self_join(spark, seed):
    """Random intervals, some with equal starts, swapped ends, copies, keys that are NULL and one hot key."""
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        key = "hot" if i % 3 == 0 else rng.choice([None, *[f"k{j}" for j in range(80)]])
        start = T0 + timedelta(hours=rng.randrange(24 * 90))
        rows.append((key, start, start + timedelta(hours=rng.randrange(-5, 40))))
    rows += rows[:20]
    frame = dim(spark, rows)
    overlaps = q.scd_overlap(frame, "k").collect()
    assert {(r.k, r.b_valid_from, r.b_valid_to) for r in overlaps} == overlapped_by_hand(rows)
    assert len(overlaps) == len(overlapped_by_hand(rows))
    for r in overlaps:
        pairs = [a for a in rows if a[0] == r.k and a[1] < r.b_valid_from and a[1] < r.b_valid_to and a[2] > r.b_valid_from]
        assert (r.a_valid_to, r.a_valid_from) == max((a[2], a[1]) for a in pairs)
    gaps = {(r.k, r.gap_to) for r in q.scd_gaps(frame, "k").collect()}
    assert gaps == {(b[0], b[1]) for b in gapped_by_hand(rows)}


def test_equal_starts_are_for_the_combination_check(spark):
    frame = dim(spark, [("x", T0, T0 + timedelta(days=1)), ("x", T0, T0 + timedelta(days=2))])
    assert q.scd_overlap(frame, "k").count() == 0
    assert q.unique_combination(frame, ["k", "valid_from"]).collect()[0].n_records == 2


def test_touching_versions_neither_overlap_nor_gap(spark):
    frame = dim(spark, [("x", T0, T0 + timedelta(days=1)), ("x", T0 + timedelta(days=1), T0 + timedelta(days=2))])
    assert q.scd_overlap(frame, "k").count() == q.scd_gaps(frame, "k").count() == 0


def test_key_without_current_version_is_seen_by_the_strict_check_only(spark):
    rows = [("none", T0, T0, False), ("one", T0, T0, True), ("two", T0, T0, True), ("two", T0, T0, True)]
    frame = spark.createDataFrame(rows, DIM)
    assert [r.k for r in q.one_current(frame, "k").collect()] == ["two"]
    assert sorted(r.k for r in q.one_current_strict(frame, "k").collect()) == ["none", "two"]


def test_null_is_left_to_not_null(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert q.not_null(child, "c").count() == 1
    assert [tuple(r) for r in q.unique(child, "c").collect()] == [("b", 2)]
    assert [r.c for r in q.relationships(child, "c", parent, "p").collect()] == ["b", "b"]
    assert [tuple(r) for r in q.orphan_counts(child, "c", parent, "p").collect()] == [("b", 2)]
    assert [tuple(r) for r in q.accepted_values(child, "c", ["a"]).collect()] == [("b", 2)]


def test_summary_names_checks_without_violations(spark):
    clean = spark.createDataFrame([("a",)], "policy_id string")
    suite = [c for c in checks() if c.name in ("unique_stg_policies_policy_id", "not_null_stg_policies_policy_id")]
    found = {r.check_name: r.violations for r in summarize({"stg_policies": clean}, suite).collect()}
    assert found == {"unique_stg_policies_policy_id": 0, "not_null_stg_policies_policy_id": 0}


def test_split_tolerates_a_cent(spark):
    money = "contribution_id string, gross_amount decimal(12,2), prf_amount decimal(12,2), pif_amount decimal(12,2), wakalah_fee_shareholders_fund decimal(12,2)"
    d = Decimal
    rows = [("ok", d(10), d("6.99"), d(2), d(1)), ("off", d(10), d("6.98"), d(2), d(1)), ("null", None, d(1), d(1), d(1))]
    found = q.fund_split(spark.createDataFrame(rows, money)).collect()
    assert [(r.contribution_id, r["diff"]) for r in found] == [("off", d("0.02"))]


def test_leakage_skips_unknown_pif(spark):
    fact = spark.createDataFrame([("1", "p", "a", Decimal(1)), ("2", "p", "b", Decimal(1)), ("3", "p", "a", Decimal(0))], "contribution_id string, policy_id string, policy_sk string, pif_amount decimal(12,2)")
    policies = spark.createDataFrame([("a", False), ("b", None)], "policy_sk string, has_pif boolean")
    assert [r.contribution_id for r in q.fund_leakage(fact, policies).collect()] == ["1"]
    assert [tuple(r) for r in q.leak_counts(fact, policies).collect()] == [("a", 1)]


def test_the_suite_has_the_50_checks():
    names = [c.name for c in checks()]
    assert len(names) == len(set(names)) == 50
    kinds = ["not_null", "unique_combination", "relationships", "accepted_values", "no_scd_overlap", "exactly_one_current"]
    assert [sum(n.startswith(k) for n in names) for k in kinds] == [22, 2, 4, 3, 2, 2]


def test_gate_names_what_failed():
    assert gate({"a": 0, "b": 0}) == 2
    with pytest.raises(GateError, match=r"b \(3\)") as error:
        gate({"a": 0, "b": 3})
    assert error.value.failed == {"b": 3}


def test_summary_in_parts_and_as_one_query_agree(spark, small):
    from catalog.shapes import FaultyTables

    tables = FaultyTables(spark, small)
    whole = {r.check_name: r.violations for r in summarize(tables).collect()}
    assert count_violations(tables) == whole
    for check in checks():
        assert check.rows(tables).count() == whole[check.name]


def test_keys_are_counted_as_they_are(spark):
    """No array is made and taken apart per row; pairs of values that read the same together stay apart."""
    suite = [c for c in checks() if c.name in ("unique_combination_dim_policies", "unique_dim_policies_policy_sk", "exactly_one_current_version_dim_policies")]
    rows = [("s", "a", T0, True), ("s", None, T0, False), (None, None, T0, True), (None, None, None, True), ("t", "a", T0 + timedelta(days=1), True)]
    table = spark.createDataFrame(rows, "policy_sk string, policy_id string, valid_from timestamp_ntz, is_current boolean")
    df = summarize({"dim_policies": table}, suite)
    assert df._jdf.queryExecution().executedPlan().toString().count("Generate inline") == 1  # the names
    found = {r.check_name.split("_dim")[0]: r.violations for r in df.collect()}
    assert found == {"unique_combination": 1, "unique": 1, "exactly_one_current_version": 2}
    pairs = spark.createDataFrame([("a", "1:b"), ("a1:", "b"), ("a", None), (None, "a"), ("-", "-"), (None, None)], "x string, y string")
    assert pairs.select(_as_text(("x", "y"))).distinct().count() == 6


def test_policies_of_a_day_are_aggregated_once(spark, small):
    from catalog.shapes import sources_of_day

    found = sources_of_day(spark, small, "2024-01-20")
    for name in ("policies", "contributions", "claims", "agency_transactions"):
        assert "Aggregate" not in found[name]._jdf.queryExecution().executedPlan().toString()
