"""Reports over the marts, and the joins of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions.frames import union_all
from martwright.operators import quality as q
from martwright.plans.facts import FACTS

Marts = dict[str, DataFrame]

_FUNDS = ["prf_amount", "pif_amount", "wakalah_fee_shareholders_fund"]


def star_view(marts: Marts, fact: str) -> DataFrame:
    """Fact rows with their policy version, product and calendar day. All joins are many to one."""
    policy = marts["dim_policies"].select(
        "policy_sk", "product_name", "has_pif", F.col("status").alias("policy_status")
    )
    product = marts["dim_product"].select("product_name", "product_sk", "product_category")
    on = FACTS[fact][1]
    day = marts["dim_date"].drop("dbt_run_started_at", "etl_loaded_at").withColumnRenamed("date_day", on)
    rows = marts[fact].drop("dbt_run_started_at", "etl_loaded_at")
    return rows.join(policy, "policy_sk", "left").join(product, "product_name", "left").join(day, on, "left")


def policies_with_participant(marts: Marts) -> DataFrame:
    """Policy versions with their participant as of now.

    Participants have versions too: without the filter a policy would repeat per version.
    """
    participant = marts["dim_participants"].filter("is_current").select("participant_id", "full_name", "state")
    return (
        marts["dim_policies"]
        .select("policy_sk", "policy_id", "participant_id", "status", "is_current")
        .join(participant, "participant_id", "left")
    )


def fund_split_exceptions(marts: Marts) -> DataFrame:
    contributions = marts["fct_contributions"]
    return contributions.filter(q.split_is_off()).select(
        "contribution_id", "policy_id", "gross_amount", *_FUNDS, q.split_difference().alias("diff")
    )


def leakage_exceptions(marts: Marts) -> DataFrame:
    return q.fund_leakage(marts["fct_contributions"], marts["dim_policies"])


def row_counts(tables: Marts, sources: Marts | None = None) -> DataFrame:
    """Rows per table, beside those of its source where one is given."""
    counts = _count_each(tables).withColumnRenamed("n", "row_count")
    if not sources:
        return counts
    return counts.join(_count_each(sources).withColumnRenamed("n", "source_count"), "table_name", "left")


def freshness(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.max("dbt_run_started_at").alias("last_run_started_at"), F.max("etl_loaded_at").alias("last_loaded_at")
    )


def policy_status(marts: Marts) -> DataFrame:
    """Policy versions by status, as the dashboard counts them."""
    return marts["dim_policies"].groupBy("status").agg(F.count("policy_id").alias("policies"))


def fund_by_category(marts: Marts) -> DataFrame:
    """Fund totals by product category; facts without a policy version come under NULL, so that the
    totals add up to the fact.

    Facts are summed per policy version first. The sums are combined before the shuffle, so a
    policy with very many contributions is no hot key, and the join moves versions, not facts.
    """
    sums = marts["fct_contributions"].groupBy("policy_sk").agg(*[F.sum(c).alias(c) for c in _FUNDS])
    category = marts["dim_policies"].select("policy_sk", "product_category")
    totals = sums.join(category, "policy_sk", "left").groupBy("product_category")
    return totals.agg(*[F.sum(c).cast("decimal(18,2)").alias(c) for c in _FUNDS])


def claims_overview(marts: Marts) -> DataFrame:
    """Claims by status and fund, with the share of the fund in the status."""
    counts = marts["fct_claims"].groupBy("status", "fund_type").agg(F.count("*").alias("claims"))
    per_status = counts.groupBy("status").agg(F.sum("claims").alias("claims_of_status"))
    return counts.join(per_status, "status").withColumn(
        "share", F.round(F.col("claims") / F.col("claims_of_status"), 6)
    )


def trace_contribution(marts: Marts, contribution_id: str) -> DataFrame:
    """One contribution through the fund split."""
    contribution = marts["fct_contributions"].filter(F.col("contribution_id") == F.lit(contribution_id))
    return contribution.select("contribution_id", "policy_id", "gross_amount", *_FUNDS, q.split_difference().alias("diff"))


def sample_rows(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(order).limit(n)


def _count_each(tables: Marts) -> DataFrame:
    return union_all(
        [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in tables.items()]
    )


def reconciliation(log: DataFrame) -> DataFrame:
    """``table_name, landed, staged, published, agrees`` of the last run in a commit log.

    The numbers are those that the writes of the run saw, so no table is scanned. ``landed`` is NULL for
    extracts that the run found; a dimension's versions aren't compared."""
    last = log.orderBy(F.desc("run_ts")).limit(1).select("rows")
    named = {"participants": "dim_participants", "policies": "dim_policies"} | {source: fact for fact, (source, _) in FACTS.items()}
    rows = [
        F.struct(
            F.lit(source).alias("table_name"),
            F.col("rows")[f"landed.{source}"].alias("landed"),
            F.col("rows")[f"staged.{source}"].alias("staged"),
            F.col("rows")[f"mart.{mart}"].alias("published"),
            F.lit(mart in FACTS).alias("fact"),
        )
        for source, mart in named.items()
    ]
    found = last.select(F.inline(F.array(*rows)))
    same = F.coalesce(F.col("landed") == F.col("staged"), F.lit(True))
    agrees = same & (~F.col("fact") | (F.col("staged") == F.col("published")))
    return found.select("table_name", "landed", "staged", "published", agrees.alias("agrees"))
