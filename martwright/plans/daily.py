"""The daily job: land, stage, keep history, build marts, check, publish."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martwright.functions.audit import timestamp, utc_naive
from martwright.functions.frames import counted, for_each
from martwright.operators.asof import choose_asof_join
from martwright.operators.history import assert_unique_key, first_load, merge_open, scd2_replay
from martwright.plans.dimensions import NATURAL_KEYS, TRACKED, dim_date, dim_participants, dim_policies, dim_product
from martwright.plans.facts import FACTS
from martwright.plans.increments import MONTH, refresh_fact
from martwright.plans.suite import GateError, checks, count_violations, gate
from martwright.schemas import MARTS, SOURCES, TIMESTAMP, VALID_FROM, conform
from martwright.sources.landing import extract_days, land, latest_day, scan_extracts
from martwright.sources.publish import export_audit, load_jdbc
from martwright.sources.store import Store


@dataclass
class Run:
    run: str
    checks_passed: int
    marts: dict[str, DataFrame] = field(repr=False)


def run_daily(
    spark: SparkSession,
    root: str,
    run_date: date,
    run_ts: datetime,
    sources: dict[str, DataFrame] | None = None,
    loaded_at: datetime | None = None,
    jdbc_url: str | None = None,
    audit_copy: bool = False,
    part_formats: dict[str, str] | None = None,
) -> Run:
    """One day, under ``root``. ``sources`` are landed first; without them, what lies in
    ``{root}/raw`` is taken. Raises ``GateError``, with nothing published, if a check fails.

    Facts are refreshed by part, see ``increments``; ``part_formats`` says how long one is, by fact (a
    month). The marts of every run are kept anyway; ``audit_copy``
    puts a second copy into dated folders.
    """
    store = Store(spark, root)
    before = store.last_commit()
    if before and before.run_ts >= utc_naive(run_ts):
        raise ValueError(f"a run at {before.run_ts} was already published; {run_ts} isn't later")
    run, raw = store.run_id(run_ts), f"{store.root}/raw"
    last = before.run if before else None

    rows: dict[str, int] = {}

    def take_in(table: str) -> str:
        if sources:
            landed, seen = counted(sources[table])
            land(landed, raw, table, run_date)
            rows[f"landed.{table}"] = seen()
        newest = max(extract_days(spark, raw, table))
        if newest > str(run_date):
            warnings.warn(f"{table}: extract of {newest} stays the latest until that day has passed")
        day, extract = latest_day(spark, raw, table)
        rows[f"staged.{table}"] = store.write_staging(run, table, conform(extract, SOURCES[table]))
        if table in NATURAL_KEYS:
            _keep_history(store, run, last, table, run_ts)
        return day

    extracts = dict(zip(SOURCES, for_each(SOURCES, take_in)))
    staged = {table: store.staging(run, table) for table in SOURCES}
    histories = {t: store.history(run, t) for t in NATURAL_KEYS}
    rows |= _build_marts(store, run, staged, histories, run_ts, last, part_formats)

    passed = _check(store, run, staged)
    if audit_copy:
        for_each(MARTS, lambda mart: export_audit(store.mart(run, mart), f"{store.root}/audit", mart, run_date))
    store.commit(run_ts, loaded_at or datetime.now(timezone.utc), extracts, rows)
    if jdbc_url:
        load_published(spark, root, jdbc_url)
    return Run(run, passed, store.published())


def load_published(spark: SparkSession, root: str, jdbc_url: str) -> None:
    """Load the marts of the last run that passed into the serving database.

    Each table is emptied and filled, so after a failure the load is simply called again.
    """
    for mart, df in Store(spark, root).published().items():
        load_jdbc(df, mart, jdbc_url)


def rebuild(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Marts from the raw zone and the commit log alone, written below ``root`` as an uncommitted run.

    The log says which day's extract each run took, so days that no run saw stay out. Raises if such a
    day was landed again with other rows, since its run can't be repeated. The run has an id of its
    own kind, so it can't overwrite what a daily run published.
    """
    store = Store(spark, root)
    last = store.last_commit()
    if not last:
        raise ValueError(f"no run was published under {root}")
    run = f"rebuild_{last.run}"

    def take_again(table: str) -> None:
        taken = _taken(store, table)
        staged = taken.filter(F.col("run") == last.run).drop("run", "run_ts")
        store.write_staging(run, table, staged)
        if table not in NATURAL_KEYS:  # one run's rows, which needn't be parsed again
            seen = store.staging(run, table).withColumn("run", F.lit(last.run))
        else:
            seen = taken
        changed = _landed_again(store, table, seen)
        if changed:
            raise ValueError(f"{table}: the extracts of these runs were landed again with other rows: {changed}")
        if table in NATURAL_KEYS:
            replayed = scd2_replay(taken.drop("run"), NATURAL_KEYS[table], TRACKED[table], "run_ts")
            store.write_versions(run, table, replayed, NATURAL_KEYS[table])

    for_each(SOURCES, take_again)
    staged = {table: store.staging(run, table) for table in SOURCES}
    histories = {t: store.history(run, t, earlier=False) for t in NATURAL_KEYS}
    _build_marts(store, run, staged, histories, last.run_ts)
    return {mart: store.mart(run, mart) for mart in MARTS}


def _taken(store: Store, table: str) -> DataFrame:
    """Rows of the raw zone as the runs that count took them, with ``run`` and ``run_ts``: one scan per
    header, joined with the log. History needs all runs, other sources the last one."""
    log = store.log().select("run", "run_ts", F.col("extracts")[table].alias("extract_date"))
    if table not in NATURAL_KEYS:
        log = log.orderBy(F.desc("run_ts")).limit(1)
    days = [row[0] for row in log.select("extract_date").distinct().collect()]  # names of day folders
    rows = scan_extracts(store.spark, f"{store.root}/raw", table, days).join(log, "extract_date")
    stamps = [StructField("run", StringType()), StructField("run_ts", TIMESTAMP)]
    return conform(rows, StructType([*SOURCES[table].fields, *stamps]))


def _landed_again(store: Store, table: str, taken: DataFrame) -> list[str]:
    """Runs in ``taken``, rows with ``run``, whose staging, where it is still kept, has other rows."""

    def digest(rows: DataFrame, name: str) -> DataFrame:
        total = F.sum(F.xxhash64(*SOURCES[table].names).cast("decimal(38,0)"))
        return rows.groupBy("run").agg(F.struct(F.count("*"), total).alias(name))

    both = digest(store.committed_staging(table), "then").join(digest(taken, "now"), "run")
    return sorted(row.run for row in both.filter(F.col("then") != F.col("now")).select("run").collect())


def _keep_history(store: Store, run: str, last: str | None, table: str, run_ts: datetime) -> None:
    key, staged = NATURAL_KEYS[table], store.staging(run, table)
    assert_unique_key(staged, key)
    if last:
        versions = merge_open(store.open_versions(last, table, key), staged, key, TRACKED[table], run_ts)
    else:
        versions = first_load(staged, key, run_ts)
    store.write_versions(run, table, versions, key, last)


def _build_marts(
    store: Store,
    run: str,
    staged: dict[str, DataFrame],
    histories: dict[str, DataFrame],
    run_ts: datetime,
    last: str | None = None,
    part_formats: dict[str, str] | None = None,
) -> dict[str, int]:
    """Rows of all marts, written. Facts read the policies as written, so the dimension isn't computed once per fact. They are built upon
    those of the run ``last``, or anew."""

    rows: dict[str, int] = {}

    def write(mart: str, df: DataFrame) -> None:
        rows[f"mart.{mart}"] = store.write_mart(run, mart, df)

    def policies_and_facts() -> None:
        write("dim_policies", dim_policies(histories["policies"], run_ts))
        policies = store.mart(run, "dim_policies")
        resolve = choose_asof_join(policies, "policy_id")
        opened = store.open_versions(run, "policies").filter(F.col(VALID_FROM) == timestamp(run_ts))

        def refresh(fact: str) -> None:
            part_format = (part_formats or {}).get(fact, MONTH)
            rows[f"mart.{fact}"] = refresh_fact(
                store, run, last, fact, staged[FACTS[fact][0]], policies, opened, run_ts, resolve, part_format
            )

        for_each(FACTS, refresh)

    def participants() -> None:
        dim = dim_participants(histories["participants"], staged["participants"], run_ts)
        write("dim_participants", dim)

    def product_and_date() -> None:
        write("dim_product", dim_product(staged["policies"], run_ts))
        write("dim_date", dim_date(store.spark, run_ts))

    for_each([policies_and_facts, participants, product_and_date], lambda build: build())
    return rows


def _check(store: Store, run: str, staged: dict[str, DataFrame]) -> int:
    """Run the suite. Rows behind a failed check are kept in quarantine before the error is raised."""
    tables = {f"stg_{t}": df for t, df in staged.items()} | {m: store.mart(run, m) for m in MARTS}
    try:
        return gate(count_violations(tables))
    except GateError as error:
        failed = [c for c in checks() if c.name in error.failed]
        for_each(failed, lambda c: store.quarantine(run, c.name, c.rows(tables)))
        raise
