"""Named queries. Each takes (spark, sf_dir), works on whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import shapes as s
from martwright.functions.audit import run_stamp, timestamp, with_loaded_at
from martwright.functions.frames import for_each, union_all
from martwright.functions.keys import surrogate_key
from martwright.operators import quality as q
from martwright.operators.asof import asof_join, asof_join_by_day, asof_join_split
from martwright.operators.history import merge_open, next_seen, scd2_merge, scd2_replay, scd2_splice
from martwright.plans import reports
from martwright.plans.daily import rebuild, run_daily
from martwright.plans.dimensions import TRACKED
from martwright.plans.facts import FACTS, build_fact
from martwright.plans.increments import written_rows
from martwright.plans.intake import Intake
from martwright.plans.suite import checks, summarize
from martwright.schemas import HISTORY_COLUMNS, SOURCES, conform
from martwright.sources import landing, publish, raw
from martwright.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]

_landed: dict[tuple[str, str], str] = {}


def landed_root(spark: SparkSession, sf_dir: str) -> str:
    """Extracts of all sources for two days, landed once per application.

    The older day has another column order, and contributions lack a column there.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _landed:
        root = s.work_folder(spark)
        newest = s.sources(spark, sf_dir)
        older = newest | {
            "participants": s.participants(spark, sf_dir, second=False),
            "policies": s.policies(spark, sf_dir, until=s.FIRST_DAY),
            "contributions": newest["contributions"].drop("payment_method"),
        }

        def land(name: str) -> None:
            landing.land(older[name].select(*reversed(older[name].columns)), root, name, s.FIRST_DAY)
            landing.land(newest[name], root, name, s.SECOND_DAY)

        for_each(SOURCES, land)
        _landed[at] = root
    return _landed[at]


# --- landing and staging ------------------------------------------------------------------


def land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land a day twice, the second time corrected: the day is replaced, and comes back unchanged."""
    root, rows = s.work_folder(spark), s.policies(spark, sf_dir)
    landing.land(rows.withColumn("status", F.lit("Lapsed")), root, "policies", s.SECOND_DAY)
    landing.land(rows, root, "policies", s.SECOND_DAY)
    return conform(landing.scan_extracts(spark, root, "policies"), SOURCES["policies"])


def scan_dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text in which records span lines, landed and scanned."""
    root = s.work_folder(spark)
    landing.land(s.dirty_text(spark, sf_dir), root, "notes", s.SECOND_DAY)
    return landing.scan_extracts(spark, root, "notes").drop("filename")


def landed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landed_root(spark, sf_dir)
    counts = [landing.landed_counts(spark, root, t).select(F.lit(t).alias("table_name"), "*") for t in SOURCES]
    return union_all(counts)


def scan_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.scan_extracts(spark, landed_root(spark, sf_dir), "contributions").drop("filename")


def extract_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = landing.scan_extracts(spark, landed_root(spark, sf_dir), "claims")
    return scan.select("claim_id", landing.extract_date(F.col("filename")).alias("extract_date"))


def latest_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.scan_latest(spark, landed_root(spark, sf_dir), "policies").drop("filename")


def raw_tolerant_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text claims, some with dates no calendar has, loaded into a typed table."""
    text = s.as_text(s.claims(spark, sf_dir))
    number = F.col("claim_id").cast("bigint")
    text = text.withColumns(
        {
            "claim_date": F.when(number % 7 == 0, "2024-02-31").otherwise(F.col("claim_date")),
            "approval_date": F.when(number % 10 == 6, "soon").otherwise(F.col("approval_date")),
        }
    )
    path = f"{s.work_folder(spark)}/raw/claims"
    raw.write_raw(text, SOURCES["claims"], path)
    return spark.read.parquet(path)


def raw_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text policies with cells of the wrong type, loaded in one pass; the cells that were left out, and why."""
    text = s.as_text(s.policies(spark, sf_dir))
    number = F.col("policy_id").cast("bigint")
    bad = {
        "start_date": F.when(number % 4 == 0, "2024-02-31").when(number % 4 == 1, "soon"),
        "end_date": F.when(number % 5 == 0, ""),
        "has_pif": F.when(number % 6 == 1, "perhaps"),
        "term_years": F.when(number % 7 == 2, "12.5").when(number % 7 == 3, "99999999999").when(number % 7 == 4, "ten"),
        "contribution_amount": F.when(number % 9 == 0, "12345678901.00").when(number % 9 == 1, "RM 5"),
    }
    text = text.withColumns({c: F.coalesce(value, F.col(c)) for c, value in bad.items()})
    path = f"{s.work_folder(spark)}/raw/policies"
    raw.write_tolerant(text, SOURCES["policies"], path)
    return raw.read_rejects(spark, path, "policy_id")


def staged(source: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(landing.scan_latest(spark, landed_root(spark, sf_dir), source), SOURCES[source])


# --- history ------------------------------------------------------------------------------


def reference_columns(history: DataFrame, source: str) -> DataFrame:
    names = SOURCES[source].names + HISTORY_COLUMNS.names[:3]
    return history.select(*names)


def policies_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_columns(s.policies_history(spark, sf_dir), "policies")


def participants_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_columns(s.participants_history(spark, sf_dir), "participants")


def merged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All daily extracts but the last replayed, then the last one merged: the same history."""
    extracts = s.policy_extracts(spark, sf_dir)
    last = extracts.agg(F.max("run_ts")).first()[0]
    key, tracked = "policy_id", TRACKED["policies"]
    before = scd2_replay(extracts.filter(F.col("run_ts") < F.lit(last)), key, tracked, "run_ts")
    newest = extracts.filter(F.col("run_ts") == F.lit(last)).drop("run_ts")
    return reference_columns(scd2_merge(before, newest, key, tracked, last), "policies")


def bucketed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last extract merged into versions that are kept in buckets by their key, which stay where they are."""
    extracts, key, tracked = s.policy_extracts(spark, sf_dir), "policy_id", TRACKED["policies"]
    last, store = extracts.agg(F.max("run_ts")).first()[0], Store(spark, s.work_folder(spark), buckets=16)
    before = scd2_replay(extracts.filter(F.col("run_ts") < F.lit(last)), key, tracked, "run_ts")
    store.write_versions("r1", "policies", before, key)
    newest = extracts.filter(F.col("run_ts") == F.lit(last)).drop("run_ts")
    merged = merge_open(store.open_versions("r1", "policies", key), newest, key, tracked, last)
    store.write_versions("r2", "policies", merged, key, "r1")
    closed = spark.read.parquet(f"{store.root}/history/policies/run=r1").filter("kept_as = 'closed'")
    both = [reference_columns(df, "policies") for df in (closed, spark.read.parquet(f"{store.root}/history/policies/run=r2"))]
    return both[0].unionByName(both[1])


LATE_DAYS = ("2024-01-20", "2024-01-05", "2024-01-12")


def late_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts of three days come after all others, in no order: the same history."""
    extracts, key, tracked = s.policy_extracts(spark, sf_dir), "policy_id", TRACKED["policies"]
    root, day = s.work_folder(spark), F.to_date("run_ts").cast("string")
    history, taken = scd2_replay(extracts.filter(~day.isin(*LATE_DAYS)), key, tracked, "run_ts"), []
    for late in LATE_DAYS:
        missing = [d for d in LATE_DAYS if d not in taken]
        rows, at = extracts.filter(day == late).drop("run_ts"), s.run_time(late) - timedelta(days=1)
        following = next_seen(extracts.filter(~day.isin(*missing)), rows, key, "run_ts", at)
        scd2_splice(history, rows, following, key, tracked, at).write.parquet(f"{root}/after={late}")
        history = spark.read.parquet(f"{root}/after={late}")
        taken.append(late)
    return reference_columns(history, "policies")


def intake_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day folders taken in by a stream, one of them after later ones."""
    root = s.work_folder(spark)
    intake = Intake(spark, root, "policies", s.run_time)
    for wave in s.INTAKE_DAYS:
        for day in wave:
            landing.land(s.policies(spark, sf_dir, until=day), f"{root}/raw", "policies", day)
        intake.run()
    return reference_columns(intake.history(), "policies")


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = s.table(spark, sf_dir, "events").join(
        s.table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"), "left"
    )
    segment = F.when(F.col("event_id") % 3 > 0, F.col("c_mktsegment"))
    return documents.select(
        "event_id", surrogate_key("event_id").alias("one"), surrogate_key("user_id", segment, "ts").alias("three")
    )


# --- facts --------------------------------------------------------------------------------


def fact(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.mart(spark, sf_dir, name)


def fact_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = s.stored_mart(spark, sf_dir, "dim_policies")
    return build_fact("fct_contributions", s.contributions(spark, sf_dir), policies, s.RUN_TS, asof_join_by_day)


def fact_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies with more than 20 versions take the other form of the as-of join."""
    policies, resolve = s.stored_mart(spark, sf_dir, "dim_policies"), partial(asof_join_split, long_history=20)
    return build_fact("fct_contributions", s.contributions(spark, sf_dir), policies, s.RUN_TS, resolve)


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status history of customers: the last order of a day sets the status."""
    orders = s.table(spark, sf_dir, "orders")
    last = F.max(F.struct("o_orderkey", "o_orderstatus")).alias("last")
    days = orders.groupBy("o_custkey", F.col("o_orderdate").alias("run_ts")).agg(last)
    extracts = days.select(F.col("o_custkey").alias("custkey"), F.col("last.o_orderstatus").alias("status"), "run_ts")
    history = scd2_replay(extracts, "custkey", ["status"], "run_ts")
    end = F.lit("9999-12-31").cast("timestamp_ntz")
    return history.select(
        "custkey",
        F.col("status").alias("version_status"),
        F.col("dbt_valid_from").alias("valid_from"),
        F.coalesce("dbt_valid_to", end).alias("valid_to"),
    )


def shipped_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = s.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag", "l_extendedprice")
    orders = s.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def asof_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by the status their customer had on the day of shipping.

    Items are summed per customer, day and flag before the as-of join: the version depends on
    nothing else.
    """
    price = F.sum(F.col("l_extendedprice").cast("decimal(12,2)"))
    daily = (
        shipped_items(spark, sf_dir)
        .groupBy("custkey", "l_shipdate", "l_returnflag")
        .agg(F.count("*").alias("items"), price.alias("price"))
    )
    resolved = asof_join(daily, customer_versions(spark, sf_dir), "custkey", "l_shipdate", ["version_status"])
    return resolved.groupBy("version_status", "l_returnflag").agg(
        F.sum("items").alias("items"), F.sum("price").cast("decimal(18,2)").alias("price")
    )


def asof_lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each single item with the status of its customer."""
    versions = customer_versions(spark, sf_dir)
    resolved = asof_join(shipped_items(spark, sf_dir), versions, "custkey", "l_shipdate", ["version_status"])
    return resolved.select("l_orderkey", "custkey", "l_shipdate", "l_returnflag", "version_status")


def fund_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fund totals by category and status as of each contribution's date.

    Contributions are summed per policy and day first; the as-of join sees no single fact.
    """
    funds = ["prf_amount", "pif_amount", "wakalah_fee_shareholders_fund"]
    facts = s.contributions(spark, sf_dir).groupBy("policy_id", "contribution_date")
    daily = facts.agg(*[F.sum(c).alias(c) for c in funds])
    policies = s.mart(spark, sf_dir, "dim_policies")
    resolved = asof_join(daily, policies, "policy_id", "contribution_date", ["product_category", "status"])
    totals = resolved.groupBy("product_category", "status")
    return totals.agg(*[F.sum(c).cast("decimal(18,2)").alias(c) for c in funds])


# --- stamps -------------------------------------------------------------------------------


def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = s.claims(spark, sf_dir).select("claim_id", run_stamp(s.RUN_TS))
    return rows.groupBy("dbt_run_started_at").agg(F.count("*").alias("n"))


def load_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_loaded_at(s.stored_mart(spark, sf_dir, "fct_claims"), s.LOADED_AT)
    return rows.groupBy("etl_loaded_at").agg(F.count("*").alias("n"))


def single_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_loaded_at(s.stored_mart(spark, sf_dir, "fct_contributions"), s.LOADED_AT)
    stamps = [q.single_value(rows.select(F.col(c).alias("stamp")), "stamp") for c in rows.columns[-2:]]
    return union_all(stamps)


# --- publishing ---------------------------------------------------------------------------


def audit_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = s.work_folder(spark)
    return spark.read.parquet(publish.export_audit(fact("fct_claims", spark, sf_dir), root, "fct_claims", s.SECOND_DAY))


def publish_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a mart twice: the second load replaces the first."""
    path = f"{s.work_folder(spark)}/marts/fct_agency_commissions"
    for _ in range(2):
        publish.publish(fact("fct_agency_commissions", spark, sf_dir), path)
    return spark.read.parquet(path)


def daily_sources(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame]]:
    """Sources of two days. On the first, all policies are active and nobody has moved yet."""
    second = s.sources(spark, sf_dir)
    first = second | {
        "participants": s.participants(spark, sf_dir, second=False),
        "policies": second["policies"].withColumn("status", F.lit("Active")),
    }
    return [first, second]


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs, then row counts of the published marts beside those of their sources."""
    root = s.work_folder(spark)
    first, second = daily_sources(spark, sf_dir)
    run_daily(spark, root, s.FIRST_DAY, s.RUN_TS.replace(day=15), first, s.LOADED_AT.replace(day=15))
    run = run_daily(spark, root, s.SECOND_DAY, s.RUN_TS, second, s.LOADED_AT)
    origins = {fact: FACTS[fact][0] for fact in FACTS} | {
        "dim_policies": "policies",
        "dim_participants": "participants",
    }
    store = Store(spark, root)
    landed = {mart: store.staging(run.run, source) for mart, source in origins.items()}
    return reports.row_counts(run.marts, landed)


_daily: dict[tuple[str, str], str] = {}


def daily_root(spark: SparkSession, sf_dir: str) -> str:
    """Three daily runs, once per application: keys change, appear, stay away and come back."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _daily:
        root = s.work_folder(spark)
        for day in s.DAILY_RUNS:
            run_daily(spark, root, day, s.run_time(day), s.sources_of_day(spark, sf_dir, day), s.LOADED_AT)
        _daily[at] = root
    return _daily[at]


def daily_mart(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return Store(spark, daily_root(spark, sf_dir)).published()[name]


def run_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows landed, staged and published by the last of three daily runs, as its writes saw them."""
    return reports.reconciliation(Store(spark, daily_root(spark, sf_dir)).log())


_growing: dict[tuple[str, str], str] = {}


def growing_root(spark: SparkSession, sf_dir: str) -> str:
    """Three daily runs over sources that grow, with facts of policies in parts of a day; once per application."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _growing:
        root = s.work_folder(spark)
        for day in s.DAILY_RUNS:
            found = s.growing_sources(spark, sf_dir, day)
            run_daily(spark, root, day, s.run_time(day), found, s.LOADED_AT, part_formats=s.PARTS)
        _growing[at] = root
    return _growing[at]


def growing_mart(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return Store(spark, growing_root(spark, sf_dir)).published()[name]


def rows_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the three runs kept of the facts and what it wrote again."""
    store = Store(spark, growing_root(spark, sf_dir))
    runs = {store.run_id(s.run_time(day)): s.run_time(day) for day in s.DAILY_RUNS}
    return union_all([written_rows(store, run).select(timestamp(at).alias("run_ts"), "*") for run, at in runs.items()])


_rebuilt: dict[tuple[str, str], dict[str, DataFrame]] = {}


def rebuilt_mart(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart again, from the raw zone and the commit log; once per application."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _rebuilt:
        _rebuilt[at] = rebuild(spark, daily_root(spark, sf_dir))
    return _rebuilt[at][name]


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows of the last run by SQL over its views."""
    Store(spark, daily_root(spark, sf_dir)).create_views()
    return spark.sql("""
        SELECT p.product_category, c.status, count(*) AS claims
        FROM stg_claims c JOIN stg_policies p ON c.policy_id = p.policy_id
        GROUP BY p.product_category, c.status""")


# --- reports ------------------------------------------------------------------------------


def report(
    build: Callable[[reports.Marts], DataFrame], names: tuple[str, ...], spark: SparkSession, sf_dir: str
) -> DataFrame:
    return build(s.marts(spark, sf_dir, *names))


def star(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.star_view(s.marts(spark, sf_dir, name, "dim_policies", "dim_product", "dim_date"), name)


def calendar_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with the number of contributions on each day."""
    days = s.mart(spark, sf_dir, "dim_date").drop("dbt_run_started_at")
    used = s.contributions(spark, sf_dir).groupBy(F.col("contribution_date").alias("date_day"))
    counts = used.agg(F.count("*").alias("n_contributions"))
    return days.join(counts, "date_day", "left").fillna(0, ["n_contributions"])


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("dim_policies", "dim_participants", "dim_product", *FACTS)
    origins = s.sources(spark, sf_dir)
    of = {f: origins[FACTS[f][0]] for f in FACTS}
    of |= {"dim_product": origins["policies"], "dim_policies": origins["policies"], "dim_participants": origins["participants"]}
    return reports.row_counts(s.marts(spark, sf_dir, *names), of)


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.freshness(with_loaded_at(s.stored_mart(spark, sf_dir, "fct_contributions"), s.LOADED_AT))


def faulty_fund_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = s.FaultyTables(spark, sf_dir)["stg_contributions"]
    return reports.fund_split_exceptions({"fct_contributions": rows})


def faulty_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    faulty = s.FaultyTables(spark, sf_dir)["fct_contributions"]
    return reports.leakage_exceptions({"fct_contributions": faulty, **s.marts(spark, sf_dir, "dim_policies")})


def leakage_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leak check on staging: by policy instead of by version."""
    leaking = s.contributions(spark, sf_dir)
    one = F.when(F.col("contribution_id").cast("bigint") % 500 == 3, F.lit(1)).otherwise(F.col("pif_amount"))
    leaking = leaking.withColumn("pif_amount", one.cast("decimal(12,2)"))
    return q.fund_leakage(leaking, s.policies(spark, sf_dir), "policy_id")


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.trace_contribution(s.marts(spark, sf_dir, "fct_contributions"), "42")


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sample_rows(s.policies(spark, sf_dir), 10, "policy_id")


def dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands with several types, and products with several categories (there is none)."""
    brands = q.dependency(s.table(spark, sf_dir, "part"), "p_brand", "p_type")
    products = q.dependency(s.policies(spark, sf_dir), "product_name", "product_category")
    agents = q.dependency(s.policies(spark, sf_dir), "agent_id", "branch")
    labelled = [
        df.select(F.lit(name).alias("dependency"), F.col(df.columns[0]).alias("determinant"), "n_values")
        for name, df in (("brand-type", brands), ("product-category", products), ("agent-branch", agents))
    ]
    return union_all(labelled)


# --- checks -------------------------------------------------------------------------------


def violations(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of one check on the faulty tables."""
    found = next(c for c in checks() if c.name == name)
    return found.rows(s.FaultyTables(spark, sf_dir))


def suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(s.FaultyTables(spark, sf_dir))


def strict_current(name: str, key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.one_current_strict(s.FaultyTables(spark, sf_dir)[name], key)


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps left when versions that lasted less than a day are taken out of the history."""
    dim = s.stored_mart(spark, sf_dir, "dim_policies")
    long = dim.filter(F.col("valid_to") >= F.col("valid_from") + F.expr("INTERVAL 36 HOURS"))
    return q.scd_gaps(long, "policy_id")


# Columns that may hold the end of time, which clients that count nanoseconds can't take.
_ENDS = ["valid_from", "valid_to", "a_valid_from", "a_valid_to", "b_valid_from", "b_valid_to"]


def _ends_as_text(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    df = query(spark, sf_dir)
    return df.withColumns({c: F.col(c).cast("string") for c in _ENDS if c in df.columns})


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {
        "fund_totals_asof": fund_totals,
        "land_roundtrip": land_roundtrip,
        "scan_dirty_text": scan_dirty_text,
        "landed_counts": landed_counts,
        "scan_union_by_name": scan_union_by_name,
        "extract_date": extract_dates,
        "latest_extract": latest_extract,
        "raw_tolerant_dates": raw_tolerant_dates,
        "raw_rejects": raw_rejects,
        **{f"stg_{source}": partial(staged, source) for source in SOURCES},
        "policies_history": policies_history,
        "participants_history": participants_history,
        "scd2_replay": customer_versions,
        "scd2_merge": merged_history,
        "scd2_merge_bucketed": bucketed_history,
        "scd2_late": late_history,
        "intake_history": intake_history,
        "surrogate_key": surrogate_keys,
        "dim_policies": partial(fact, "dim_policies"),
        "dim_participants": partial(fact, "dim_participants"),
        "dim_product": partial(fact, "dim_product"),
        "dim_date": calendar_use,
        **{name: partial(fact, name) for name in FACTS},
        "fct_contributions_by_day": fact_by_day,
        "fct_contributions_mixed": fact_mixed,
        "asof_lineitem": asof_lineitem,
        "asof_lineitem_rows": asof_lineitem_rows,
        "run_stamp": run_stamps,
        "load_stamp": load_stamps,
        "dq_single_stamp": single_stamp,
        "audit_export_roundtrip": audit_export_roundtrip,
        "publish_idempotent": publish_idempotent,
        "daily_refresh": daily_refresh,
        "daily_dim_policies": partial(daily_mart, "dim_policies"),
        "daily_dim_participants": partial(daily_mart, "dim_participants"),
        "daily_fct_contributions": partial(daily_mart, "fct_contributions"),
        "daily_fct_agency_commissions": partial(daily_mart, "fct_agency_commissions"),
        "run_reconciliation": run_reconciliation,
        "incremental_fct_contributions": partial(growing_mart, "fct_contributions"),
        "incremental_fct_agency_commissions": partial(growing_mart, "fct_agency_commissions"),
        "incremental_rows_written": rows_written,
        **{f"rebuild_{mart}": partial(rebuilt_mart, mart) for mart in ("dim_policies", "dim_participants", *FACTS)},
        "stg_view_sql": views,
        "star_fact_view": partial(star, "fct_contributions"),
        "star_claims_view": partial(star, "fct_claims"),
        "star_commissions_view": partial(star, "fct_agency_commissions"),
        "star_participants_current": partial(
            report, reports.policies_with_participant, ("dim_policies", "dim_participants")
        ),
        "rpt_row_counts": row_counts,
        "rpt_freshness": freshness,
        "rpt_status": partial(report, reports.policy_status, ("dim_policies",)),
        "rpt_fund_by_category": partial(report, reports.fund_by_category, ("fct_contributions", "dim_policies")),
        "rpt_claims": partial(report, reports.claims_overview, ("fct_claims",)),
        "rpt_fund_split": faulty_fund_split,
        "rpt_leakage": faulty_leakage,
        "trace_fact": trace,
        "sample_rows": sample,
        "fd_check": dependencies,
        "dq_fund_leakage_staging": leakage_staging,
        "dq_one_current_strict_dim_policies": partial(strict_current, "dim_policies", "policy_id"),
        "dq_one_current_strict_dim_participants": partial(strict_current, "dim_participants", "participant_id"),
        "dq_scd_gaps": gaps,
        "dq_suite_summary": suite_summary,
    }
    for check in checks():
        found[f"dq_{check.name}"] = partial(violations, check.name)
    return {name: partial(_ends_as_text, query) for name, query in found.items()}
