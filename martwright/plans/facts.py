"""The three facts: staging rows with the surrogate key of the policy version in effect."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from martwright.functions.audit import run_stamp
from martwright.operators.asof import AsofJoin, asof_join
from martwright.schemas import as_mart

# Fact -> (source, date that decides the version).
FACTS = {
    "fct_contributions": ("contributions", "contribution_date"),
    "fct_claims": ("claims", "claim_date"),
    "fct_agency_commissions": ("agency_transactions", "transaction_date"),
}


def build_fact(
    mart: str, staged: DataFrame, policies: DataFrame, run_ts: datetime, resolve: AsofJoin = asof_join
) -> DataFrame:
    """``resolve`` is the as-of join to use; ``asof_join_split`` picks one for each key."""
    date_col = FACTS[mart][1]
    resolved = resolve(staged, policies, "policy_id", date_col, ["policy_sk"])
    return as_mart(resolved.select("*", run_stamp(run_ts)), mart)
