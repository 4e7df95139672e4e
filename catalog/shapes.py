"""The five sources, their extracts and faulty copies, derived from the given tables.

Everything is a projection or an aggregate of whole tables, so it grows with them. A
``% n = k`` only decides where a fault is injected; no row is left out.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.audit import timestamp
from martwright.operators.history import scd2_replay
from martwright.plans.dimensions import TRACKED, dim_date, dim_participants, dim_policies, dim_product
from martwright.plans.facts import FACTS, build_fact

RUN_TS = datetime(2024, 1, 31, 2, 0, 0)
LOADED_AT = datetime(2024, 1, 31, 2, 15, 30)
FIRST_DAY, SECOND_DAY = "2024-01-15", "2024-01-30"

#: Days of three daily runs, and the last digit of the ids that are away on each.
DAILY_RUNS = {"2024-01-10": "1", "2024-01-20": "2", "2024-01-30": None}

#: Days of extracts that a stream takes in, in the order in which their folders come.
INTAKE_DAYS = [["2024-01-06", "2024-01-18", "2024-01-24"], ["2024-01-12", "2024-01-30"]]

#: Facts that are kept by day rather than by month.
PARTS = {"fct_contributions": "yyyy-MM-dd", "fct_claims": "yyyy-MM-dd"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder all executors see, below the one the cluster names for checkpoints."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/martwright-{uuid.uuid4().hex}"


_stored: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table written once per application, as marts and staging are; read back by its users."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at in _stored:
        try:
            return spark.read.parquet(_stored[at])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    path = f"{work_folder(spark)}/{name}"
    build().write.parquet(path)
    _stored[at] = path
    return spark.read.parquet(path)


# --- policies, from events -------------------------------------------------------------


def policy_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily extracts: the last event of each user and day gives the policy's row that day.

    A day holds only the users active on it. ``run_ts`` is the run that takes the day in.
    """
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    last = _last_event(events, "user_id", "day")
    run_ts = F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 2 HOURS")
    return last.select(*_policy_columns(), run_ts.alias("run_ts"))


def policies(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """A full extract: the last event of each user, at the end of day ``until`` or overall."""
    events = table(spark, sf_dir, "events")
    if until:
        events = events.filter(F.col("ts") < F.date_add(F.lit(until).cast("date"), 1).cast("timestamp_ntz"))
    return _last_event(events, "user_id").select(*_policy_columns())


def _last_event(events: DataFrame, *keys: str) -> DataFrame:
    """One event per group: combined before the shuffle, so a busy user is no hot key."""
    columns = ["ts", "event_id", "event_type", "value"]
    return events.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("last")).select(*keys, "last.*")


def _policy_columns() -> list[Column]:
    user = F.col("user_id")
    family = user % 2 == 0
    category = F.when(family, "Family").otherwise("General")
    status = (
        F.when(F.col("event_type").isin("signup", "click"), "Active")
        .when(F.col("event_type") == "view", "Lapsed")
        .when(F.col("event_type") == "purchase", "Matured")
        .otherwise("Cancelled")
    )
    mode = F.when(F.col("event_id") % 3 == 0, "Monthly").when(F.col("event_id") % 3 == 1, "Quarterly")
    start = F.date_add(F.lit("2020-01-01").cast("date"), (user % 1000).cast("int"))
    amount = 100 + (user % 9) * 25 + F.when(F.col("event_type") == "purchase", 50).otherwise(0)
    agent = (user + F.when(F.col("value") >= 100, 1).otherwise(0)) % 50
    return [
        user.cast("string").alias("policy_id"),
        user.cast("string").alias("participant_id"),
        F.concat(category, F.lit(" plan "), (user % 7).cast("string")).alias("product_name"),
        category.alias("product_category"),
        family.alias("has_pif"),
        start.alias("start_date"),
        F.date_add(start, 3650).alias("end_date"),
        (10 + user % 20).cast("int").alias("term_years"),
        mode.otherwise("Yearly").alias("payment_mode"),
        amount.cast("decimal(12,2)").alias("contribution_amount"),
        status.alias("status"),
        F.concat(F.lit("A"), agent.cast("string")).alias("agent_id"),
        F.concat(F.lit("Branch "), (user % 16).cast("string")).alias("branch"),
    ]


# --- participants, from customers ---------------------------------------------------------


def participants(spark: SparkSession, sf_dir: str, second: bool = True) -> DataFrame:
    """One of two full extracts; in the second a tenth has moved and all names have changed."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    moved = (key % 10 == 0) & F.lit(second)
    home = F.when(moved, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    placed = customer.withColumn("home", home).join(nation, F.col("home") == F.col("n_nationkey"))
    return placed.select(
        key.cast("string").alias("participant_id"),
        F.concat("c_name", F.lit("*" if second else "")).alias("full_name"),
        F.lpad(key.cast("string"), 12, "0").alias("ic_number"),
        F.date_add(F.lit("1950-01-01").cast("date"), (key % 18000).cast("int")).alias("date_of_birth"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("n_name").alias("state"),
        F.date_add(F.lit("2015-01-01").cast("date"), (key % 3000).cast("int")).alias("join_date"),
    )


def participant_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = participants(spark, sf_dir, second=False).withColumn("run_ts", timestamp(datetime(2024, 1, 1, 2)))
    second = participants(spark, sf_dir).withColumn("run_ts", timestamp(datetime(2024, 1, 15, 2)))
    return first.unionByName(second)


# --- transactions -------------------------------------------------------------------------


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    gross = F.col("value").cast("decimal(12,2)")
    fee = (F.col("gross_amount") * F.lit("0.10").cast("decimal(5,2)")).cast("decimal(12,2)")
    third = (F.col("gross_amount") * F.lit("0.30").cast("decimal(5,2)")).cast("decimal(12,2)")
    pif = F.when(F.col("user_id") % 2 == 0, third).otherwise(F.lit(0).cast("decimal(12,2)"))
    rest = F.col("gross_amount") - F.col("wakalah_fee_shareholders_fund") - F.col("pif_amount")
    events = table(spark, sf_dir, "events").withColumn("gross_amount", gross)
    split = events.select("*", fee.alias("wakalah_fee_shareholders_fund"), pif.alias("pif_amount"))
    method = F.when(F.col("event_id") % 3 == 0, "FPX").when(F.col("event_id") % 3 == 1, "Card").otherwise("Cash")
    return split.select(
        F.col("event_id").cast("string").alias("contribution_id"),
        F.col("user_id").cast("string").alias("policy_id"),
        F.col("ts").cast("date").alias("contribution_date"),
        "gross_amount",
        "wakalah_fee_shareholders_fund",
        rest.cast("decimal(12,2)").alias("prf_amount"),
        "pif_amount",
        method.alias("payment_method"),
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(F.col("event_id") % 4 == 0, "Pending")
        .when(F.col("event_id") % 4 == 1, "Under Review")
        .when(F.col("event_id") % 4 == 2, "Approved")
        .otherwise("Rejected")
    )
    day = F.col("ts").cast("date")
    kind = F.when(F.col("event_type") == "error", "Death").when(F.col("event_type") == "purchase", "Medical")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("claim_id"),
        F.col("user_id").cast("string").alias("policy_id"),
        kind.otherwise("Disability").alias("claim_type"),
        day.alias("claim_date"),
        F.col("value").cast("decimal(12,2)").alias("claim_amount"),
        F.lit("PRF").alias("fund_type"),
        status.alias("status"),
        F.when(F.col("event_id") % 4 == 2, F.date_add(day, 14)).alias("approval_date"),
    )


def agency_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("o_custkey")
    kind = F.when(F.col("o_orderstatus") == "F", "New Business").when(F.col("o_orderstatus") == "O", "Renewal")
    commission = F.col("o_totalprice").cast("decimal(12,2)") * F.lit("0.05").cast("decimal(5,2)")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.concat(F.lit("A"), (customer % 50).cast("string")).alias("agent_id"),
        F.expr("o_custkey div 10").cast("string").alias("policy_id"),
        kind.otherwise("Clawback").alias("transaction_type"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        (5 + customer % 10).cast("decimal(5,2)").alias("commission_rate"),
        commission.cast("decimal(12,2)").alias("commission_amount_shareholders_fund"),
    )


_SOURCES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "participants": participants,
    "policies": policies,
    "contributions": contributions,
    "claims": claims,
    "agency_transactions": agency_transactions,
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source as of the latest extract."""
    return _SOURCES[name](spark, sf_dir)


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: source(spark, sf_dir, name) for name in _SOURCES}


def run_time(day: str) -> datetime:
    """The run that takes in a day: at two o'clock of the next one."""
    return datetime.fromisoformat(day) + timedelta(days=1, hours=2)


def sources_of_day(spark: SparkSession, sf_dir: str, day: str) -> dict[str, DataFrame]:
    """Sources as one of ``DAILY_RUNS`` finds them: what happened until then.

    Participants who are away, their policies and all that belongs to them are missing that day, so
    they appear later, or stay away and come back. Nobody is away on the last day, which has all rows.
    """
    found = sources(spark, sf_dir)
    found["participants"] = participants(spark, sf_dir, second=day > FIRST_DAY)
    found["policies"] = policies(spark, sf_dir, until=day)
    if DAILY_RUNS[day]:
        for name in ("participants", "policies"):
            found[name] = found[name].filter(~F.col("participant_id").endswith(DAILY_RUNS[day]))
        # Landed, and joined by three facts: aggregated from the events once.
        there = found["policies"]
        found["policies"] = stored(spark, sf_dir, f"policies_{day}", lambda: there)
        known = found["policies"].select("policy_id")
        for name, date_col in FACTS.values():
            facts = found[name]
            if name != "agency_transactions":
                facts = facts.filter(F.col(date_col) <= F.lit(day).cast("date"))
            found[name] = facts.join(known, "policy_id", "left_semi").select(*facts.columns)
    return found


def growing_sources(spark: SparkSession, sf_dir: str, day: str) -> dict[str, DataFrame]:
    """Sources at the end of a day: what happened until then, nobody away."""
    found = sources(spark, sf_dir)
    found["participants"] = participants(spark, sf_dir, second=day > FIRST_DAY)
    found["policies"] = policies(spark, sf_dir, until=day)
    for name, date_col in (("contributions", "contribution_date"), ("claims", "claim_date")):
        found[name] = found[name].filter(F.col(date_col) <= F.lit(day).cast("date"))
    return found


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events as free text: with newlines, CRs, blank lines, quotes and delimiters put in."""
    n, props = F.col("event_id") % 8, F.coalesce("props", F.lit(""))
    text = (
        F.when(n == 0, F.concat(F.lit("line one\n\n\nline \"four\"\n"), props))
        .when(n == 1, F.concat(F.lit("a\rb, c\r\nd,"), props, F.lit("\r\n")))
        .when(n == 2, F.concat(F.lit('"'), F.replace(props, F.lit(":"), F.lit('"\n,"'))))
        .when(n == 3, F.replace(props, F.lit('"'), F.lit('"\n"')))
        .when(n == 4, F.lit('",\n",'))
        .when(n == 5, F.lit(" spaced "))
        .when(n == 6, props)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), text.alias("text"), F.col("event_type").alias("last")
    )


# --- histories and marts ------------------------------------------------------------------


def policies_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_replay(policy_extracts(spark, sf_dir), "policy_id", TRACKED["policies"], "run_ts")


def participants_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_replay(participant_extracts(spark, sf_dir), "participant_id", TRACKED["participants"], "run_ts")


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plan of a mart; a fact joins the stored dimension."""
    if name == "dim_policies":
        return dim_policies(policies_history(spark, sf_dir), RUN_TS)
    if name == "dim_participants":
        return dim_participants(participants_history(spark, sf_dir), participants(spark, sf_dir), RUN_TS)
    if name == "dim_product":
        return dim_product(policies(spark, sf_dir), RUN_TS)
    if name == "dim_date":
        return dim_date(spark, RUN_TS)
    staged = source(spark, sf_dir, FACTS[name][0])
    return build_fact(name, staged, stored_mart(spark, sf_dir, "dim_policies"), RUN_TS)


def stored_mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return stored(spark, sf_dir, name, lambda: mart(spark, sf_dir, name))


def marts(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: stored_mart(spark, sf_dir, name) for name in names}


# --- faulty copies: every check of the suite must find something ----------------------------


def _number(column: str) -> Column:
    return F.col(column).cast("bigint")


def _null_where(df: DataFrame, condition: Column, *columns: str) -> DataFrame:
    return df.withColumns({c: F.when(~condition, F.col(c)) for c in columns})


def _shifted(column: str, by: int, condition: Column) -> Column:
    return F.when(condition, (_number(column) + by).cast("string")).otherwise(F.col(column))


def _faulty_transactions(df: DataFrame, key: str, n: int) -> DataFrame:
    """Some policies unknown, some missing, some ids missing, some rows twice. ``n``: how rare."""
    number = F.col("__n")
    rows = df.withColumn("__n", _number(key))
    rows = rows.withColumn("policy_id", _shifted("policy_id", 10000, number % (2 * n) == 5))
    rows = _null_where(rows, number % (5 * n) == 11, "policy_id")
    rows = rows.unionByName(rows.filter(number % n == 0))
    return _null_where(rows, number % (10 * n) == 13, key).drop("__n")


def faulty_staging(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``stg_<source>`` with faults."""
    of = name.removeprefix("stg_")
    df = source(spark, sf_dir, of)
    if of == "participants":
        key = _number("participant_id")
        df = df.unionByName(df.filter(key % 100 == 0))
        return _null_where(df, key % 200 == 9, "participant_id")
    if of == "policies":
        key = F.col("__n")
        df = df.withColumn("__n", _number("policy_id"))
        df = df.withColumn("participant_id", _shifted("participant_id", 1_000_000, key % 40 == 3))
        df = df.withColumn("status", F.when(key % 30 == 4, "Suspended").otherwise(F.col("status")))
        df = _null_where(df, key % 70 == 8, "participant_id")
        df = df.unionByName(df.filter(key % 50 == 0))
        return _null_where(df, key % 60 == 7, "policy_id").drop("__n")
    if of == "contributions":
        off = F.when(_number("contribution_id") % 1000 == 7, F.lit("0.02").cast("decimal(12,2)")).otherwise(0)
        df = df.withColumn("prf_amount", (F.col("prf_amount") + off).cast("decimal(12,2)"))
        return _faulty_transactions(df, "contribution_id", 100)
    if of == "claims":
        key = _number("claim_id")
        df = df.withColumn("fund_type", F.when(key % 400 == 1, "INVALID_FUND").otherwise(F.col("fund_type")))
        df = df.withColumn("status", F.when(key % 300 == 2, "Lost").otherwise(F.col("status")))
        return _faulty_transactions(df, "claim_id", 50)
    return _faulty_transactions(df, "transaction_id", 100)


def _faulty_versions(dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Overlapping, doubled and missing current versions, repeated rows, keys that are NULL."""
    number = F.col("__n")
    dim = dim.withColumn("__n", _number(key))
    current, last_day = dim.filter("is_current"), F.lit("9999-12-31").cast("timestamp_ntz")
    day_before = F.lit("9999-12-30").cast("timestamp_ntz")
    inside = current.filter(number % 45 == 2).withColumns(
        {
            surrogate: F.concat(surrogate, F.lit("-inside")),
            "valid_from": day_before,
            "is_current": F.lit(False),
        }
    )
    second = current.filter(number % 35 == 3).withColumns(
        {surrogate: F.concat(surrogate, F.lit("-second")), "valid_from": last_day}
    )
    rows = dim.withColumn("is_current", F.col("is_current") & (number % 55 != 4))
    rows = rows.unionByName(inside).unionByName(second).unionByName(dim.filter(number % 80 == 5))
    rows = _null_where(rows, (number % 60 == 7) & F.col("is_current"), surrogate)
    return _null_where(rows, number % 90 == 6, key).drop("__n")


def faulty_mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mart with faults."""
    df = stored_mart(spark, sf_dir, name)
    if name == "dim_policies":
        return _faulty_versions(df, "policy_id", "policy_sk")
    if name == "dim_participants":
        return _faulty_versions(df, "participant_id", "participant_sk")
    if name == "dim_product":
        df = df.unionByName(df.filter(F.col("product_name").endswith("0")))
        return _null_where(df, F.col("product_name").endswith("1"), "product_sk", "product_name")
    if name == "dim_date":
        used = contributions(spark, sf_dir).select(F.col("contribution_date").alias("date_day")).distinct()
        df = df.unionByName(df.join(used, "date_day").filter("day_of_month = 15").select(*df.columns))
        marked = df.join(used.withColumn("__used", F.lit(True)), "date_day", "left")
        return _null_where(marked, F.coalesce("__used", F.lit(False)) & (F.col("day_of_month") == 16), "date_day").drop(
            "__used"
        )
    key = {"fct_contributions": "contribution_id", "fct_claims": "claim_id"}.get(name, "transaction_id")
    number = F.col("__n")
    df = df.withColumn("__n", _number(key))
    if name == "fct_contributions":
        one = F.lit(1).cast("decimal(12,2)")
        df = df.withColumn("pif_amount", F.when(number % 500 == 3, one).otherwise(F.col("pif_amount")))
    df = _null_where(df, number % 250 == 4, "policy_sk")
    df = df.unionByName(df.filter(number % 100 == 0))
    return _null_where(df, number % 1000 == 13, key).drop("__n")


class FaultyTables(dict):
    """All tables the suite needs, with faults, each stored when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        build = faulty_staging if name.startswith("stg_") else faulty_mart
        self[name] = stored(
            self.spark, self.sf_dir, f"faulty_{name}", lambda: build(self.spark, self.sf_dir, name)
        )
        return self[name]


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
