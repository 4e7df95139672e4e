"""Facts by increments: a run writes again only the parts of a fact that its extract or its versions touch.

A fact is kept in parts, one per month of the date that decides its version. Per part, the number of staged
rows and the sum of their hashes say whether the extract changed anything in it, without comparing it with
the last one row by row. A version that is opened touches the parts with facts of its key from that time
on, or from the beginning for a key's first one; versions that are closed are followed by one that is opened.
All other parts are kept where an earlier run wrote them, and a manifest per run says which run that is.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from martwright.functions.audit import BEGINNING, run_stamp, timestamp
from martwright.operators.asof import AsofJoin, asof_join
from martwright.plans.facts import FACTS, build_fact
from martwright.schemas import FIRST_VERSION, VALID_FROM
from martwright.sources.store import Store

#: Part of rows without a date.
NO_DATE = "none"


#: A part per month.
MONTH = "yyyy-MM"


def part_of(date_col: str, of: str = MONTH) -> Column:
    """The name of the part a date belongs to."""
    return F.coalesce(F.date_format(date_col, of), F.lit(NO_DATE))


def part_digests(staged: DataFrame, part: Column, date_col: str | None = None) -> DataFrame:
    """``part, rows, digest``: equal for equal rows, in whatever order. One pass, combined before the shuffle.

    Two sums of differently seeded hashes; what is kept by mistake would need both to agree by chance. Thirds of
    hashes are added up as integers, which hold the sums of 2^41 rows of a date. ``date_col`` is what ``part`` is made of:
    with it rows are combined by date first, so that parts are named per date rather than per row."""
    hashes = [F.xxhash64(F.lit(seed), *staged.columns) for seed in (1, 2)]
    thirds = [F.shiftrightunsigned(h, bits).bitwiseAND(F.lit(2**22 - 1)) for h in hashes for bits in (0, 21, 42)]
    names = [f"__sum{n}" for n in range(len(thirds))]
    group = F.col(date_col) if date_col else part.alias("part")
    sums = [F.sum(third).alias(name) for third, name in zip(thirds, names)]
    found = staged.groupBy(group).agg(F.count("*").alias("rows"), *sums)
    totals = [F.sum(F.col(name).cast("decimal(38,0)")).cast("string") for name in names]
    grouped = found.groupBy(part.alias("part") if date_col else F.col("part"))
    return grouped.agg(F.sum("rows").alias("rows"), F.concat_ws("/", *totals).alias("digest"))


def touched_parts(staged: DataFrame, part: Column, date_col: str, opened: DataFrame, key: str) -> DataFrame:
    """``part``: those with facts that ``opened`` versions may resolve anew.

    An equi join with the time as residual, one row per key on the side of the versions, so AQE can split a
    hot key of the facts."""
    since = F.when(F.col(FIRST_VERSION), timestamp(BEGINNING)).otherwise(F.col(VALID_FROM))
    versions = opened.select(F.col(key).alias("__key"), since.alias("__since"))
    facts = staged.select(key, date_col)
    found = facts.join(versions, (F.col(key) == F.col("__key")) & (F.col(date_col) >= F.col("__since")))
    return found.select(date_col).distinct().select(part.alias("part")).distinct()


def refresh_fact(
    store: Store,
    run: str,
    last: str | None,
    mart: str,
    staged: DataFrame,
    policies: DataFrame,
    opened: DataFrame,
    run_ts: datetime,
    resolve: AsofJoin = asof_join,
    part_format: str = MONTH,
) -> int:
    """Write the touched parts of a fact and the manifest of ``run``, which follows ``last``.

    Without a ``last``, or a manifest of it, all parts are written; so they are if ``part_format`` has changed.
    A part that is empty now is left out. Returns the rows of the fact: those written and those kept."""
    date_col = FACTS[mart][1]
    part = part_of(date_col, part_format)
    # The list of parts grows by one a month, so it may be on the driver.
    now = part_digests(staged, part, date_col).select("*", run_stamp(run_ts)).collect()
    before = {p.part: p for p in store.parts(last, mart).collect()} if last else {}
    kept = {p.part: before[p.part].written_by for p in now if p.part in before and before[p.part].digest == p.digest}
    if kept:  # else all parts are written, whatever versions touch
        for row in touched_parts(staged, part, date_col, opened, "policy_id").collect():
            kept.pop(row.part, None)
    manifest = [
        Row(part=p.part, rows=p["rows"], digest=p.digest, written_by=kept.get(p.part, run), dbt_run_started_at=p[-1])
        for p in now
    ]
    store.write_parts(run, mart, manifest)

    written = [p.part for p in manifest if p.part not in kept]
    kept_rows = sum(p["rows"] for p in manifest if p.part in kept)
    if manifest and not written:
        return kept_rows
    chosen = staged.withColumn("part", part)
    if kept:
        chosen = chosen.filter(F.col("part").isin(written))
    resolved = build_fact(mart, chosen.select(*staged.columns), policies, run_ts, resolve)
    rows_per_part = sum(p["rows"] for p in manifest if p.part not in kept) / max(len(written), 1)
    written_fact = resolved.drop("dbt_run_started_at").withColumn("part", part)
    return kept_rows + store.write_fact(run, mart, written_fact, rows_per_part)


def written_rows(store: Store, run: str) -> DataFrame:
    """``mart, parts, parts_written, rows, rows_written`` of a run: what it kept and what it wrote again."""
    own = F.col("written_by") == run
    counts = [
        F.count("*").alias("parts"),
        F.count_if(own).alias("parts_written"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(own, F.col("rows"))), F.lit(0)).alias("rows_written"),
    ]
    found = [store.parts(run, mart).agg(*counts).select(F.lit(mart).alias("mart"), "*") for mart in FACTS]
    return found[0].unionAll(found[1]).unionAll(found[2])
