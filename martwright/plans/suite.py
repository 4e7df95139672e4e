"""The 50 checks, their summary and the gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.frames import PARALLEL_JOBS, for_each, union_all
from martwright.operators import quality as q

Tables = dict[str, DataFrame]

# Which rule applies where.
NOT_NULL = {
    "stg_participants": ["participant_id"],
    "stg_policies": ["policy_id", "participant_id"],
    "stg_contributions": ["contribution_id", "policy_id"],
    "stg_claims": ["claim_id", "policy_id"],
    "stg_agency_transactions": ["transaction_id", "policy_id"],
    "dim_policies": ["policy_sk", "policy_id"],
    "dim_participants": ["participant_sk", "participant_id"],
    "dim_product": ["product_sk", "product_name"],
    "dim_date": ["date_day"],
    "fct_contributions": ["contribution_id", "policy_sk"],
    "fct_claims": ["claim_id", "policy_sk"],
    "fct_agency_commissions": ["transaction_id", "policy_sk"],
}
UNIQUE = {
    "stg_participants": ["participant_id"],
    "stg_policies": ["policy_id"],
    "stg_contributions": ["contribution_id"],
    "stg_claims": ["claim_id"],
    "stg_agency_transactions": ["transaction_id"],
    "dim_policies": ["policy_sk"],
    "dim_participants": ["participant_sk"],
    "dim_product": ["product_sk", "product_name"],
    "dim_date": ["date_day"],
    "fct_contributions": ["contribution_id"],
    "fct_claims": ["claim_id"],
    "fct_agency_commissions": ["transaction_id"],
}
RELATIONSHIPS = [
    ("stg_policies", "participant_id", "stg_participants", "participant_id"),
    ("stg_contributions", "policy_id", "stg_policies", "policy_id"),
    ("stg_claims", "policy_id", "stg_policies", "policy_id"),
    ("stg_agency_transactions", "policy_id", "stg_policies", "policy_id"),
]
ACCEPTED = [
    ("stg_policies", "status", ["Active", "Lapsed", "Matured", "Cancelled"]),
    ("stg_claims", "fund_type", ["PRF", "PIF"]),
    ("stg_claims", "status", ["Pending", "Under Review", "Approved", "Rejected"]),
]
VERSIONED = {"dim_policies": "policy_id", "dim_participants": "participant_id"}


@dataclass(frozen=True)
class Marks:
    """How violations are counted along with those of other rules: rows of ``table`` that ``where``
    holds for are marked. Violations are the marked rows or, with a ``key``, its values with more than
    ``allowed`` of them."""

    table: str
    where: Callable[[], Column]
    key: tuple[str, ...] = ()
    allowed: int = 0


@dataclass(frozen=True)
class Check:
    """A rule on named tables; ``rows`` gives its violations."""

    name: str
    rows: Callable[[Tables], DataFrame]
    #: Rows with a column ``violations`` that add up to the number of violations, where that is
    #: cheaper to get than the violations.
    tally: Callable[[Tables], DataFrame] | None = None
    #: For a rule on single rows, or on how often a key occurs.
    marks: Marks | None = None

    def tallied(self, tables: Tables) -> DataFrame:
        name = F.lit(self.name).alias("check_name")
        if self.tally:
            return self.tally(tables).select(name, "violations")
        return self.rows(tables).select(name, F.lit(1).cast("bigint").alias("violations"))


def checks() -> list[Check]:
    found: list[Check] = []

    def add(name: str, rule: Callable[..., DataFrame], *of: str, args: tuple = (), **more) -> None:
        found.append(Check(name, lambda tables: rule(*[tables[t] for t in of], *args), **more))

    for table, columns in NOT_NULL.items():
        for c in columns:
            add(f"not_null_{table}_{c}", q.not_null, table, args=(c,), marks=Marks(table, partial(_is_null, c)))
    for table, columns in UNIQUE.items():
        for c in columns:
            add(f"unique_{table}_{c}", q.unique, table, args=(c,), marks=Marks(table, partial(_present, c), (c,), 1))
    for child, c, parent, field in RELATIONSHIPS:
        found.append(
            Check(
                f"relationships_{child}_{c}",
                partial(_orphans, q.relationships, child, c, parent, field),
                tally=partial(_orphans, q.orphan_counts, child, c, parent, field),
            )
        )
    for table, c, values in ACCEPTED:
        outside = Marks(table, partial(_outside, c, values), (c,))
        add(f"accepted_values_{table}_{c}", q.accepted_values, table, args=(c, values), marks=outside)
    for table, key in VERSIONED.items():
        version = (key, "valid_from")
        same = Marks(table, partial(F.lit, True), version, 1)
        add(f"unique_combination_{table}", q.unique_combination, table, args=(list(version),), marks=same)
        add(f"no_scd_overlap_{table}", q.scd_overlap, table, args=(key,))
        current = Marks(table, partial(F.col, "is_current"), (key,), 1)
        add(f"exactly_one_current_version_{table}", q.one_current, table, args=(key,), marks=current)
    off = Marks("stg_contributions", q.split_is_off)
    add("fund_split_invariant", q.fund_split, "stg_contributions", marks=off)
    add("no_pif_leakage", q.fund_leakage, "fct_contributions", "dim_policies", tally=_leaks)
    return found


def summarize(tables: Tables, suite: list[Check] | None = None) -> DataFrame:
    """One row per check, ``check_name`` and ``violations``, as a single query.

    Rules on single rows share one pass over their table; rules on how often a key occurs share one aggregate
    over all tables; what the others find is added up in one more.
    """
    suite = checks() if suite is None else suite
    found = [c.tallied(tables) for c in suite if not c.marks]
    marked = [c for c in suite if c.marks]
    found += _counted_rows(tables, [c for c in marked if not c.marks.key])
    found += _counted_keys(tables, [c for c in marked if c.marks.key])
    each = [F.struct(F.lit(c.name).alias("check_name"), F.lit(0).cast("bigint").alias("violations")) for c in suite]
    none = found[0].sparkSession.range(1).select(F.inline(F.array(*each)))
    return union_all([none, *found]).groupBy("check_name").agg(F.sum("violations").alias("violations"))


def _counted_rows(tables: Tables, marked: list[Check]) -> list[DataFrame]:
    """``check_name, violations`` of rules on single rows: per table one row, combined before any shuffle."""
    by_table: dict[str, list[Check]] = {}
    for check in marked:
        by_table.setdefault(check.marks.table, []).append(check)
    counts = []
    for table, of in by_table.items():
        found = tables[table].agg(*[F.count_if(c.marks.where()).alias(c.name) for c in of])
        each = [F.struct(F.lit(c.name).alias("check_name"), F.col(c.name).alias("violations")) for c in of]
        counts.append(found.select(F.inline(F.array(*each))))
    return counts


def _counted_keys(tables: Tables, marked: list[Check]) -> list[DataFrame]:
    """``check_name, violations`` of rules on how often a key occurs. Marked rows become the check's number and
    the key as text; equal ones are combined before they are shuffled, once for all tables."""
    if not marked:
        return []
    keys = [
        tables[c.marks.table].filter(c.marks.where()).select(F.lit(number).alias("check"), _as_text(c.marks.key).alias("key"))
        for number, c in enumerate(marked, start=1)
    ]
    counts = union_all(keys).groupBy("check", "key").agg(F.count("*").alias("n"))
    name, allowed = (
        F.element_at(F.array(*[F.lit(value) for value in values]), F.col("check"))
        for values in zip(*[(c.name, c.marks.allowed) for c in marked])
    )
    return [counts.filter(F.col("n") > allowed).select(name.alias("check_name"), F.lit(1).cast("bigint").alias("violations"))]


def _as_text(key: tuple[str, ...]) -> Column:
    """One text per key; of several columns, each with its length, so that no two keys give the same."""
    values = [F.col(c).cast("string") for c in key]
    if len(values) == 1:
        return values[0]
    return F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def count_violations(tables: Tables, suite: list[Check] | None = None) -> dict[str, int]:
    """Violations per check: the summary in several parts that are planned and run side by side."""
    suite = checks() if suite is None else suite
    marked, others = [c for c in suite if c.marks], [c for c in suite if not c.marks]
    parts = [part for part in (marked, *(others[i :: PARALLEL_JOBS] for i in range(PARALLEL_JOBS))) if part]
    rows = for_each(parts, lambda part: summarize(tables, part).collect())  # one small row per check
    return {row.check_name: row.violations for part in rows for row in part}


class GateError(RuntimeError):
    """Checks found violations; nothing may be published."""

    def __init__(self, failed: dict[str, int]):
        self.failed = failed
        super().__init__("failed checks: " + ", ".join(f"{name} ({n})" for name, n in sorted(failed.items())))


def gate(violations: dict[str, int]) -> int:
    """Raise if any check has violations, else return how many checks passed."""
    failed = {name: n for name, n in violations.items() if n}
    if failed:
        raise GateError(failed)
    return len(violations)


def _is_null(column: str) -> Column:
    return F.col(column).isNull()


def _present(column: str) -> Column:
    return F.col(column).isNotNull()


def _outside(column: str, values: list[str]) -> Column:
    return ~F.col(column).isin(values)


def _leaks(tables: Tables) -> DataFrame:
    return q.leak_counts(tables["fct_contributions"], tables["dim_policies"])


def _orphans(rule, child: str, column: str, parent: str, field: str, tables: Tables) -> DataFrame:
    return rule(tables[child], column, tables[parent], field)
