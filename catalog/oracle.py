"""The same queries as SQL for the oracle, written from the rules, not from the Spark code."""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2024-01-31 02:00:00'"
LOADED_AT = "TIMESTAMP '2024-01-31 02:15:30'"
STAMP = f"{RUN_TS} AS dbt_run_started_at"

POLICY_COLUMNS = """
    cast(user_id AS varchar) AS policy_id,
    cast(user_id AS varchar) AS participant_id,
    (CASE WHEN user_id % 2 = 0 THEN 'Family' ELSE 'General' END) || ' plan ' || cast(user_id % 7 AS varchar) AS product_name,
    CASE WHEN user_id % 2 = 0 THEN 'Family' ELSE 'General' END AS product_category,
    user_id % 2 = 0 AS has_pif,
    DATE '2020-01-01' + cast(user_id % 1000 AS integer) AS start_date,
    DATE '2020-01-01' + cast(user_id % 1000 AS integer) + 3650 AS end_date,
    cast(10 + user_id % 20 AS integer) AS term_years,
    CASE event_id % 3 WHEN 0 THEN 'Monthly' WHEN 1 THEN 'Quarterly' ELSE 'Yearly' END AS payment_mode,
    cast(100 + (user_id % 9) * 25 + (CASE WHEN event_type = 'purchase' THEN 50 ELSE 0 END) AS decimal(12,2)) AS contribution_amount,
    CASE WHEN event_type IN ('signup', 'click') THEN 'Active' WHEN event_type = 'view' THEN 'Lapsed'
         WHEN event_type = 'purchase' THEN 'Matured' ELSE 'Cancelled' END AS status,
    'A' || cast((user_id + (CASE WHEN value >= 100 THEN 1 ELSE 0 END)) % 50 AS varchar) AS agent_id,
    'Branch ' || cast(user_id % 16 AS varchar) AS branch
"""

_POLICY_ATTRIBUTES = """policy_id, participant_id, product_name, product_category, has_pif, start_date, end_date,
           term_years, payment_mode, status, agent_id, contribution_amount"""
_PARTICIPANT_ATTRIBUTES = "h.participant_id, c.full_name, c.ic_number, h.state, c.date_of_birth, c.gender, c.join_date"
_CONTRIBUTIONS = """f.contribution_id, f.policy_id, d.policy_sk, f.contribution_date, f.gross_amount, f.prf_amount,
           f.pif_amount, f.wakalah_fee_shareholders_fund, f.payment_method"""
_COMMISSIONS = """f.transaction_id, f.agent_id, f.policy_id, d.policy_sk, f.transaction_type, f.transaction_date,
           f.commission_rate, f.commission_amount_shareholders_fund"""

MARKER = "'_dbt_utils_surrogate_key_null_'"


def _sk(*fields: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(cast({f} AS varchar), {MARKER})" for f in fields) + ")"


def _participants(moved: str, suffix: str) -> str:
    return f"""
    SELECT cast(c_custkey AS varchar) AS participant_id, c_name || '{suffix}' AS full_name,
           lpad(cast(c_custkey AS varchar), 12, '0') AS ic_number,
           DATE '1950-01-01' + cast(c_custkey % 18000 AS integer) AS date_of_birth,
           CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           n_name AS state,
           DATE '2015-01-01' + cast(c_custkey % 3000 AS integer) AS join_date
    FROM customer JOIN nation ON n_nationkey = {moved}"""


def _dimension(history: str, key: str, sk: str, attributes: str, source: str = "") -> str:
    return f"""
    SELECT {_sk('h.' + key, 'h.dbt_valid_from')} AS {sk}, {attributes},
           CASE WHEN row_number() OVER (PARTITION BY h.{key} ORDER BY h.dbt_valid_from) = 1
                THEN TIMESTAMP '1900-01-01' ELSE h.dbt_valid_from END AS valid_from,
           coalesce(h.dbt_valid_to, TIMESTAMP '9999-12-31') AS valid_to,
           h.dbt_valid_to IS NULL AS is_current, {STAMP}
    FROM {history} h {source}"""


def _asof(source: str, columns: str, day: str, dim: str = "dim_policies") -> str:
    return f"""
    SELECT {columns}, {STAMP}
    FROM {source} f LEFT JOIN {dim} d
      ON f.policy_id = d.policy_id AND f.{day} >= d.valid_from AND f.{day} < d.valid_to"""


def _versions(extracts: str, key: str, *tracked: str) -> str:
    """An extract opens a version where it differs from the last one that has the key."""
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in tracked)
    return f"""
    SELECT * EXCLUDE (run_ts), run_ts AS dbt_valid_from,
           lead(run_ts) OVER (PARTITION BY {key} ORDER BY run_ts) AS dbt_valid_to
    FROM (SELECT * FROM {extracts} WINDOW w AS (PARTITION BY {key} ORDER BY run_ts)
          QUALIFY lag(run_ts) OVER w IS NULL OR {changed})"""


def _faulty_transactions(source: str, key: str, n: int, others: str) -> str:
    """Shift, then null policies, then repeat rows, then null ids."""
    number = f"cast({key} AS bigint)"
    shifted = f"""SELECT * REPLACE (CASE WHEN {number} % {5 * n} = 11 THEN NULL
                    WHEN {number} % {2 * n} = 5 THEN cast(cast(policy_id AS bigint) + 10000 AS varchar)
                    ELSE policy_id END AS policy_id{others}) FROM {source}"""
    return f"""
    SELECT * REPLACE (CASE WHEN {number} % {10 * n} = 13 THEN NULL ELSE {key} END AS {key})
    FROM (SELECT * FROM ({shifted}) UNION ALL (SELECT * FROM ({shifted}) WHERE {number} % {n} = 0))"""


def _faulty_versions(dim: str, key: str, sk: str) -> str:
    n = f"cast({key} AS bigint)"
    return f"""
    SELECT * REPLACE (CASE WHEN {n} % 90 = 6 THEN NULL ELSE {key} END AS {key},
                      CASE WHEN {n} % 60 = 7 AND is_current THEN NULL ELSE {sk} END AS {sk})
    FROM (
        SELECT * REPLACE (is_current AND {n} % 55 <> 4 AS is_current) FROM {dim}
        UNION ALL
        SELECT * REPLACE ({sk} || '-inside' AS {sk}, TIMESTAMP '9999-12-30' AS valid_from, false AS is_current)
        FROM {dim} WHERE is_current AND {n} % 45 = 2
        UNION ALL
        SELECT * REPLACE ({sk} || '-second' AS {sk}, TIMESTAMP '9999-12-31' AS valid_from)
        FROM {dim} WHERE is_current AND {n} % 35 = 3
        UNION ALL
        SELECT * FROM {dim} WHERE {n} % 80 = 5
    )"""


def _faulty_fact(fact: str, key: str, others: str = "") -> str:
    n = f"cast({key} AS bigint)"
    rows = f"SELECT * REPLACE (CASE WHEN {n} % 250 = 4 THEN NULL ELSE policy_sk END AS policy_sk{others}) FROM {fact}"
    return f"""
    SELECT * REPLACE (CASE WHEN {n} % 1000 = 13 THEN NULL ELSE {key} END AS {key})
    FROM (SELECT * FROM ({rows}) UNION ALL (SELECT * FROM ({rows}) WHERE {n} % 100 = 0))"""


_OFF = "CASE WHEN cast(contribution_id AS bigint) % 1000 = 7 THEN 0.02 ELSE 0 END"
_LEAK = "CASE WHEN cast(contribution_id AS bigint) % 500 = 3 THEN 1 ELSE pif_amount END"

CTES = {
    "last_of_day": """
    SELECT *, cast(ts AS date) AS day FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, cast(ts AS date) ORDER BY ts DESC, event_id DESC) = 1""",
    "policy_extracts": f"""
    SELECT {POLICY_COLUMNS}, cast(day AS timestamp) + INTERVAL 2 HOUR AS run_ts FROM last_of_day""",
    "policies": f"""
    SELECT {POLICY_COLUMNS} FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "policies_first": f"""
    SELECT {POLICY_COLUMNS} FROM events WHERE ts < TIMESTAMP '2024-01-16'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "policy_changes": """
    SELECT * FROM policy_extracts
    WINDOW w AS (PARTITION BY policy_id ORDER BY run_ts)
    QUALIFY lag(run_ts) OVER w IS NULL OR status IS DISTINCT FROM lag(status) OVER w
         OR agent_id IS DISTINCT FROM lag(agent_id) OVER w
         OR contribution_amount IS DISTINCT FROM lag(contribution_amount) OVER w""",
    "policies_history": """
    SELECT * EXCLUDE (run_ts), run_ts AS dbt_valid_from,
           lead(run_ts) OVER (PARTITION BY policy_id ORDER BY run_ts) AS dbt_valid_to,
           md5(policy_id || '|' || cast(run_ts AS varchar)) AS dbt_scd_id
    FROM policy_changes""",
    "participants_first": _participants("c_nationkey", ""),
    "participants": _participants(
        "(CASE WHEN c_custkey % 10 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END)", "*"
    ),
    "participants_history": """
    SELECT a.*, TIMESTAMP '2024-01-01 02:00:00' AS dbt_valid_from,
           CASE WHEN a.state <> b.state THEN TIMESTAMP '2024-01-15 02:00:00' END AS dbt_valid_to,
           md5(a.participant_id || '|2024-01-01 02:00:00') AS dbt_scd_id
    FROM participants_first a JOIN participants b USING (participant_id)
    UNION ALL
    SELECT b.*, TIMESTAMP '2024-01-15 02:00:00', NULL, md5(b.participant_id || '|2024-01-15 02:00:00')
    FROM participants_first a JOIN participants b USING (participant_id) WHERE a.state <> b.state""",
    "contributions_gross": "SELECT *, cast(value AS decimal(12,2)) AS gross_amount FROM events",
    "contributions_split": """
    SELECT *, cast(gross_amount * cast(0.10 AS decimal(5,2)) AS decimal(12,2)) AS wakalah_fee_shareholders_fund,
           CASE WHEN user_id % 2 = 0 THEN cast(gross_amount * cast(0.30 AS decimal(5,2)) AS decimal(12,2))
                ELSE cast(0 AS decimal(12,2)) END AS pif_amount
    FROM contributions_gross""",
    "contributions": """
    SELECT cast(event_id AS varchar) AS contribution_id, cast(user_id AS varchar) AS policy_id,
           cast(ts AS date) AS contribution_date, gross_amount, wakalah_fee_shareholders_fund,
           cast(gross_amount - wakalah_fee_shareholders_fund - pif_amount AS decimal(12,2)) AS prf_amount, pif_amount,
           CASE event_id % 3 WHEN 0 THEN 'FPX' WHEN 1 THEN 'Card' ELSE 'Cash' END AS payment_method
    FROM contributions_split""",
    "claims": """
    SELECT cast(event_id AS varchar) AS claim_id, cast(user_id AS varchar) AS policy_id,
           CASE event_type WHEN 'error' THEN 'Death' WHEN 'purchase' THEN 'Medical' ELSE 'Disability' END AS claim_type,
           cast(ts AS date) AS claim_date, cast(value AS decimal(12,2)) AS claim_amount, 'PRF' AS fund_type,
           CASE event_id % 4 WHEN 0 THEN 'Pending' WHEN 1 THEN 'Under Review' WHEN 2 THEN 'Approved'
                ELSE 'Rejected' END AS status,
           CASE WHEN event_id % 4 = 2 THEN cast(ts AS date) + 14 END AS approval_date
    FROM events""",
    "agency_transactions": """
    SELECT cast(o_orderkey AS varchar) AS transaction_id, 'A' || cast(o_custkey % 50 AS varchar) AS agent_id,
           cast(o_custkey // 10 AS varchar) AS policy_id,
           CASE o_orderstatus WHEN 'F' THEN 'New Business' WHEN 'O' THEN 'Renewal' ELSE 'Clawback' END AS transaction_type,
           cast(o_orderdate AS date) AS transaction_date, cast(5 + o_custkey % 10 AS decimal(5,2)) AS commission_rate,
           cast(cast(o_totalprice AS decimal(12,2)) * cast(0.05 AS decimal(5,2)) AS decimal(12,2))
               AS commission_amount_shareholders_fund
    FROM orders""",
    "dim_policies": _dimension(
        "policies_history",
        "policy_id",
        "policy_sk",
        _POLICY_ATTRIBUTES,
    ),
    "dim_participants": _dimension(
        "participants_history",
        "participant_id",
        "participant_sk",
        _PARTICIPANT_ATTRIBUTES,
        "LEFT JOIN participants c ON h.participant_id = c.participant_id",
    ),
    "dim_product": f"""
    SELECT {_sk('product_name')} AS product_sk, product_name, product_category, {STAMP}
    FROM policies GROUP BY product_name, product_category""",
    "dim_date": f"""
    SELECT cast(d AS date) AS date_day, cast(year(d) AS integer) AS year, cast(quarter(d) AS integer) AS quarter,
           cast(month(d) AS integer) AS month, strftime(d, '%B') AS month_name, cast(day(d) AS integer) AS day_of_month,
           cast(dayofweek(d) AS integer) AS day_of_week, strftime(d, '%A') AS day_name,
           dayofweek(d) IN (0, 6) AS is_weekend, {STAMP}
    FROM generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2047-12-31', INTERVAL 1 DAY) AS days(d)""",
    "fct_contributions": _asof(
        "contributions",
        _CONTRIBUTIONS,
        "contribution_date",
    ),
    "fct_claims": _asof(
        "claims",
        """f.claim_id, f.policy_id, d.policy_sk, f.claim_type, f.claim_date, f.claim_amount, f.fund_type, f.status,
           f.approval_date""",
        "claim_date",
    ),
    "fct_agency_commissions": _asof(
        "agency_transactions",
        _COMMISSIONS,
        "transaction_date",
    ),
    # three daily runs
    "daily_runs": """
    SELECT * FROM (VALUES (TIMESTAMP '2024-01-11 02:00:00', 1), (TIMESTAMP '2024-01-21 02:00:00', 2),
                          (TIMESTAMP '2024-01-31 02:00:00', NULL)) runs(run_ts, away)""",
    "daily_policies": f"""
    SELECT {POLICY_COLUMNS}, run_ts FROM events JOIN daily_runs ON ts < run_ts - INTERVAL 2 HOUR
    WHERE away IS NULL OR user_id % 10 <> away
    QUALIFY row_number() OVER (PARTITION BY user_id, run_ts ORDER BY ts DESC, event_id DESC) = 1""",
    "daily_participants": """
    SELECT p.*, run_ts FROM participants_first p, daily_runs
    WHERE away = 1 AND cast(participant_id AS bigint) % 10 <> 1
    UNION ALL
    SELECT p.*, run_ts FROM participants p, daily_runs
    WHERE away IS NULL OR (away = 2 AND cast(participant_id AS bigint) % 10 <> 2)""",
    "daily_policies_history": _versions("daily_policies", "policy_id", "status", "agent_id", "contribution_amount"),
    "daily_participants_history": _versions("daily_participants", "participant_id", "state"),
    "daily_dim_policies": _dimension("daily_policies_history", "policy_id", "policy_sk", _POLICY_ATTRIBUTES),
    "daily_dim_participants": _dimension(
        "daily_participants_history",
        "participant_id",
        "participant_sk",
        _PARTICIPANT_ATTRIBUTES,
        "LEFT JOIN participants c ON h.participant_id = c.participant_id",
    ),
    "daily_fct_contributions": _asof("contributions", _CONTRIBUTIONS, "contribution_date", "daily_dim_policies"),
    "daily_fct_agency_commissions": _asof(
        "agency_transactions", _COMMISSIONS, "transaction_date", "daily_dim_policies"
    ),
    "daily_fct_claims": _asof(
        "claims",
        """f.claim_id, f.policy_id, d.policy_sk, f.claim_type, f.claim_date, f.claim_amount, f.fund_type, f.status,
           f.approval_date""",
        "claim_date",
        "daily_dim_policies",
    ),
    # three daily runs over sources that grow
    "growing_policies": f"""
    SELECT {POLICY_COLUMNS}, run_ts FROM events JOIN daily_runs ON ts < run_ts - INTERVAL 2 HOUR
    QUALIFY row_number() OVER (PARTITION BY user_id, run_ts ORDER BY ts DESC, event_id DESC) = 1""",
    "growing_policies_history": _versions(
        "growing_policies", "policy_id", "status", "agent_id", "contribution_amount"
    ),
    "growing_dim_policies": _dimension("growing_policies_history", "policy_id", "policy_sk", _POLICY_ATTRIBUTES),
    "growing_facts": """
    SELECT run_ts, mart, cast(ts AS date) AS day, user_id AS key
    FROM events JOIN daily_runs ON ts < run_ts - INTERVAL 2 HOUR, (VALUES ('fct_contributions'), ('fct_claims')) m(mart)
    UNION ALL
    SELECT run_ts, 'fct_agency_commissions', cast(date_trunc('month', o_orderdate) AS date), o_custkey // 10
    FROM orders, daily_runs""",
    "first_seen": """
    SELECT user_id AS key, min(run_ts) AS seen FROM events JOIN daily_runs ON ts < run_ts - INTERVAL 2 HOUR
    GROUP BY user_id""",
    # days taken in by a stream
    "intake_policies": f"""
    SELECT {POLICY_COLUMNS}, run_ts
    FROM events JOIN (SELECT unnest(range(TIMESTAMP '2024-01-07 02:00:00', TIMESTAMP '2024-02-01', INTERVAL 6 DAY)) AS run_ts)
      ON ts < run_ts - INTERVAL 2 HOUR
    QUALIFY row_number() OVER (PARTITION BY user_id, run_ts ORDER BY ts DESC, event_id DESC) = 1""",
    "intake_policies_history": _versions("intake_policies", "policy_id", "status", "agent_id", "contribution_amount"),
    # faulty copies
    "x_stg_participants": """
    SELECT * REPLACE (CASE WHEN cast(participant_id AS bigint) % 200 = 9 THEN NULL ELSE participant_id END AS participant_id)
    FROM (SELECT * FROM participants UNION ALL
          SELECT * FROM participants WHERE cast(participant_id AS bigint) % 100 = 0)""",
    "x_policies_marked": """
    SELECT * REPLACE (
        CASE WHEN cast(policy_id AS bigint) % 70 = 8 THEN NULL
             WHEN cast(policy_id AS bigint) % 40 = 3 THEN cast(cast(participant_id AS bigint) + 1000000 AS varchar)
             ELSE participant_id END AS participant_id,
        CASE WHEN cast(policy_id AS bigint) % 30 = 4 THEN 'Suspended' ELSE status END AS status)
    FROM policies""",
    "x_stg_policies": """
    SELECT * REPLACE (CASE WHEN cast(policy_id AS bigint) % 60 = 7 THEN NULL ELSE policy_id END AS policy_id)
    FROM (SELECT * FROM x_policies_marked UNION ALL
          SELECT * FROM x_policies_marked WHERE cast(policy_id AS bigint) % 50 = 0)""",
    "x_stg_contributions": _faulty_transactions(
        "contributions",
        "contribution_id",
        100,
        f", cast(prf_amount + {_OFF} AS decimal(12,2)) AS prf_amount",
    ),
    "x_stg_claims": _faulty_transactions(
        "claims",
        "claim_id",
        50,
        """, CASE WHEN cast(claim_id AS bigint) % 400 = 1 THEN 'INVALID_FUND' ELSE fund_type END AS fund_type,
           CASE WHEN cast(claim_id AS bigint) % 300 = 2 THEN 'Lost' ELSE status END AS status""",
    ),
    "x_stg_agency_transactions": _faulty_transactions("agency_transactions", "transaction_id", 100, ""),
    "x_dim_policies": _faulty_versions("dim_policies", "policy_id", "policy_sk"),
    "x_dim_participants": _faulty_versions("dim_participants", "participant_id", "participant_sk"),
    "x_dim_product": """
    SELECT * REPLACE (CASE WHEN product_name LIKE '%1' THEN NULL ELSE product_sk END AS product_sk,
                      CASE WHEN product_name LIKE '%1' THEN NULL ELSE product_name END AS product_name)
    FROM (SELECT * FROM dim_product UNION ALL SELECT * FROM dim_product WHERE product_name LIKE '%0')""",
    "x_dim_date": """
    SELECT * REPLACE (CASE WHEN day_of_month = 16 AND date_day IN (SELECT contribution_date FROM contributions)
                           THEN NULL ELSE date_day END AS date_day)
    FROM (SELECT * FROM dim_date UNION ALL
          SELECT * FROM dim_date
          WHERE day_of_month = 15 AND date_day IN (SELECT contribution_date FROM contributions))""",
    "x_fct_contributions": _faulty_fact(
        "fct_contributions", "contribution_id", f", cast({_LEAK} AS decimal(12,2)) AS pif_amount"
    ),
    "x_fct_claims": _faulty_fact("fct_claims", "claim_id"),
    "x_fct_agency_commissions": _faulty_fact("fct_agency_commissions", "transaction_id"),
    # customers and items
    "customer_days": """
    SELECT o_custkey AS custkey, o_orderstatus AS status, o_orderdate AS run_ts FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC, o_orderstatus DESC) = 1""",
    "customer_changes": """
    SELECT * FROM customer_days
    WINDOW w AS (PARTITION BY custkey ORDER BY run_ts)
    QUALIFY lag(run_ts) OVER w IS NULL OR status IS DISTINCT FROM lag(status) OVER w""",
    "customer_versions": """
    SELECT custkey, status AS version_status, run_ts AS valid_from,
           coalesce(lead(run_ts) OVER (PARTITION BY custkey ORDER BY run_ts), TIMESTAMP '9999-12-31') AS valid_to
    FROM customer_changes""",
    "shipped_items": """
    SELECT l_orderkey, o_custkey AS custkey, l_shipdate, l_returnflag, l_extendedprice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items_asof": """
    SELECT i.*, v.version_status FROM shipped_items i LEFT JOIN customer_versions v
      ON i.custkey = v.custkey AND i.l_shipdate >= v.valid_from AND i.l_shipdate < v.valid_to""",
}

_DIFF = "gross_amount - (prf_amount + pif_amount + wakalah_fee_shareholders_fund)"
_FUND_SUMS = ", ".join(
    f"cast(sum({c}) AS decimal(18,2)) AS {c}" for c in ("prf_amount", "pif_amount", "wakalah_fee_shareholders_fund")
)
_TEXT_CONTRIBUTIONS = ", ".join(
    f"cast({c} AS varchar) AS {c}"
    for c in (
        "contribution_id",
        "policy_id",
        "contribution_date",
        "gross_amount",
        "wakalah_fee_shareholders_fund",
        "prf_amount",
        "pif_amount",
    )
)
_POLICY_NAMES = """policy_id participant_id product_name product_category has_pif start_date end_date term_years
    payment_mode contribution_amount status agent_id branch""".split()


def _star(fact: str, day: str) -> str:
    return f"""
    SELECT f.* EXCLUDE (dbt_run_started_at), p.product_name, p.has_pif, p.status AS policy_status,
           r.product_sk, r.product_category, d.* EXCLUDE (date_day, dbt_run_started_at)
    FROM {fact} f LEFT JOIN dim_policies p ON f.policy_sk = p.policy_sk
         LEFT JOIN dim_product r ON p.product_name = r.product_name
         LEFT JOIN dim_date d ON f.{day} = d.date_day"""


def _overlap(dim: str, key: str) -> str:
    """Self join of the versions; of the earlier ones, the one that reaches furthest."""
    return f"""
    SELECT a.{key}, a.valid_from AS a_valid_from, a.valid_to AS a_valid_to,
           b.valid_from AS b_valid_from, b.valid_to AS b_valid_to
    FROM (SELECT DISTINCT {key}, valid_from, valid_to FROM {dim}) a
    JOIN (SELECT DISTINCT {key}, valid_from, valid_to FROM {dim}) b
      ON a.{key} = b.{key} AND a.valid_from < b.valid_from AND a.valid_from < b.valid_to AND a.valid_to > b.valid_from
    QUALIFY row_number() OVER (PARTITION BY b.{key}, b.valid_from, b.valid_to
                               ORDER BY a.valid_to DESC, a.valid_from DESC) = 1"""


def _current(dim: str, key: str) -> str:
    return f"""SELECT {key}, count(*) AS current_version_count FROM {dim} WHERE is_current
               GROUP BY {key} HAVING count(*) <> 1"""


def _current_strict(dim: str, key: str) -> str:
    return f"""SELECT {key}, cast(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS bigint) AS current_version_count
               FROM {dim} GROUP BY {key}
               HAVING sum(CASE WHEN is_current THEN 1 ELSE 0 END) <> 1"""


def _combination(dim: str, key: str) -> str:
    return f"SELECT {key}, valid_from, count(*) AS n_records FROM {dim} GROUP BY {key}, valid_from HAVING count(*) > 1"


def _leakage(fact: str, dim: str, key: str) -> str:
    return f"""SELECT f.contribution_id, f.policy_id, f.pif_amount, d.has_pif FROM {fact} f JOIN {dim} d
               ON f.{key} = d.{key} WHERE d.has_pif = false AND f.pif_amount <> 0"""


_LEAKY = f"(SELECT * REPLACE (cast({_LEAK} AS decimal(12,2)) AS pif_amount) FROM contributions)"

CHECKS = {
    **{
        f"not_null_{t}_{c}": f"SELECT * FROM x_{t} WHERE {c} IS NULL"
        for t, cs in {
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
        }.items()
        for c in cs
    },
    **{
        f"unique_{t}_{c}": f"""SELECT {c} AS unique_field, count(*) AS n_records FROM x_{t}
                               WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"""
        for t, c in [
            ("stg_participants", "participant_id"),
            ("stg_policies", "policy_id"),
            ("stg_contributions", "contribution_id"),
            ("stg_claims", "claim_id"),
            ("stg_agency_transactions", "transaction_id"),
            ("dim_policies", "policy_sk"),
            ("dim_participants", "participant_sk"),
            ("dim_product", "product_sk"),
            ("dim_product", "product_name"),
            ("dim_date", "date_day"),
            ("fct_contributions", "contribution_id"),
            ("fct_claims", "claim_id"),
            ("fct_agency_commissions", "transaction_id"),
        ]
    },
    **{
        f"relationships_{child}_{c}": f"""SELECT c.* FROM x_{child} c LEFT JOIN (SELECT DISTINCT {c} AS known FROM x_{parent}) p
                                          ON c.{c} = p.known WHERE c.{c} IS NOT NULL AND p.known IS NULL"""
        for child, c, parent in [
            ("stg_policies", "participant_id", "stg_participants"),
            ("stg_contributions", "policy_id", "stg_policies"),
            ("stg_claims", "policy_id", "stg_policies"),
            ("stg_agency_transactions", "policy_id", "stg_policies"),
        ]
    },
    **{
        f"accepted_values_{t}_{c}": f"""SELECT {c} AS value_field, count(*) AS n_records FROM x_{t}
                                        WHERE {c} NOT IN ({values}) GROUP BY {c}"""
        for t, c, values in [
            ("stg_policies", "status", "'Active', 'Lapsed', 'Matured', 'Cancelled'"),
            ("stg_claims", "fund_type", "'PRF', 'PIF'"),
            ("stg_claims", "status", "'Pending', 'Under Review', 'Approved', 'Rejected'"),
        ]
    },
    "unique_combination_dim_policies": _combination("x_dim_policies", "policy_id"),
    "unique_combination_dim_participants": _combination("x_dim_participants", "participant_id"),
    "no_scd_overlap_dim_policies": _overlap("x_dim_policies", "policy_id"),
    "no_scd_overlap_dim_participants": _overlap("x_dim_participants", "participant_id"),
    "exactly_one_current_version_dim_policies": _current("x_dim_policies", "policy_id"),
    "exactly_one_current_version_dim_participants": _current("x_dim_participants", "participant_id"),
    "fund_split_invariant": f"""
    SELECT contribution_id, gross_amount, prf_amount, pif_amount, wakalah_fee_shareholders_fund, {_DIFF} AS diff
    FROM x_stg_contributions WHERE abs({_DIFF}) > 0.01""",
    "no_pif_leakage": _leakage("x_fct_contributions", "x_dim_policies", "policy_sk"),
}

_SUMMARY = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, count(*) AS violations FROM ({sql})" for name, sql in CHECKS.items()
)

_COUNTS = {
    "dim_policies": ("dim_policies", "policies"),
    "dim_participants": ("dim_participants", "participants"),
    "dim_product": ("dim_product", "policies"),
    "fct_contributions": ("fct_contributions", "contributions"),
    "fct_claims": ("fct_claims", "claims"),
    "fct_agency_commissions": ("fct_agency_commissions", "agency_transactions"),
}

#: Two full runs: a participant who moved, and a policy whose tracked columns changed, has two versions.
_DAILY = {
    "dim_policies": (
        "(SELECT count(*) + sum(CASE WHEN status <> 'Active' THEN 1 ELSE 0 END) FROM policies)",
        "(SELECT count(*) FROM policies)",
    ),
    "dim_participants": ("(SELECT count(*) FROM participants_history)", "(SELECT count(*) FROM participants)"),
    "dim_product": ("(SELECT count(*) FROM dim_product)", "NULL"),
    "dim_date": ("(SELECT count(*) FROM dim_date)", "NULL"),
    "fct_contributions": ("(SELECT count(*) FROM contributions)",) * 2,
    "fct_claims": ("(SELECT count(*) FROM claims)",) * 2,
    "fct_agency_commissions": ("(SELECT count(*) FROM agency_transactions)",) * 2,
}

QUERIES = {
    "fund_totals_asof": f"""
    SELECT p.product_category, p.status, {_FUND_SUMS}
    FROM fct_contributions f LEFT JOIN dim_policies p ON f.policy_sk = p.policy_sk GROUP BY ALL""",
    "land_roundtrip": "SELECT * FROM policies",
    "scan_dirty_text": f"""
    SELECT cast(event_id AS varchar) AS event_id,
           CASE event_id % 8
             WHEN 0 THEN 'line one' || chr(10) || chr(10) || chr(10) || 'line "four"' || chr(10) || p
             WHEN 1 THEN 'a' || chr(13) || 'b, c' || chr(13) || chr(10) || 'd,' || p || chr(13) || chr(10)
             WHEN 2 THEN '"' || replace(p, ':', '"' || chr(10) || ',"')
             WHEN 3 THEN nullif(replace(p, '"', '"' || chr(10) || '"'), '')
             WHEN 4 THEN '",' || chr(10) || '",'
             WHEN 5 THEN ' spaced ' WHEN 6 THEN nullif(p, '') END AS text,
           event_type AS last, '2024-01-30' AS extract_date
    FROM (SELECT *, coalesce(props, '') AS p FROM events)""",
    "landed_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{day}' AS extract_date, count(*) AS row_count FROM {t}{older}"
        for t in ("participants", "policies", "contributions", "claims", "agency_transactions")
        for day, older in (("2024-01-15", "_first" if t == "policies" else ""), ("2024-01-30", ""))
    ),
    "scan_union_by_name": f"""
    SELECT {_TEXT_CONTRIBUTIONS}, payment_method, '2024-01-30' AS extract_date FROM contributions
    UNION ALL SELECT {_TEXT_CONTRIBUTIONS}, NULL, '2024-01-15' FROM contributions""",
    "extract_date": """
    SELECT claim_id, day AS extract_date FROM claims, (VALUES ('2024-01-15'), ('2024-01-30')) days(day)""",
    "latest_extract": "SELECT "
    + ", ".join(f"cast({c} AS varchar) AS {c}" for c in _POLICY_NAMES)
    + ", '2024-01-30' AS extract_date FROM policies",
    "raw_tolerant_dates": """
    SELECT * REPLACE (
        CASE WHEN cast(claim_id AS bigint) % 7 = 0 THEN NULL ELSE claim_date END AS claim_date,
        CASE WHEN cast(claim_id AS bigint) % 10 = 6 THEN NULL ELSE approval_date END AS approval_date)
    FROM claims""",
    **{
        f"stg_{t}": f"SELECT * FROM {t}"
        for t in ("participants", "policies", "contributions", "claims", "agency_transactions")
    },
    "raw_rejects": """
    SELECT policy_id, column_name, value, reason
    FROM (SELECT policy_id, cast(policy_id AS bigint) AS n FROM policies), (VALUES
        ('start_date', 4, 0, '2024-02-31', 'no such day'), ('start_date', 4, 1, 'soon', 'not a date'),
        ('has_pif', 6, 1, 'perhaps', 'not a boolean'),
        ('term_years', 7, 2, '12.5', 'not whole'), ('term_years', 7, 3, '99999999999', 'out of range'),
        ('term_years', 7, 4, 'ten', 'not a number'),
        ('contribution_amount', 9, 0, '12345678901.00', 'out of range'),
        ('contribution_amount', 9, 1, 'RM 5', 'not a number')) bad(column_name, m, k, value, reason)
    WHERE n % m = k""",
    "policies_history": "SELECT * FROM policies_history",
    "participants_history": "SELECT * FROM participants_history",
    "scd2_merge": "SELECT * FROM policies_history",
    "scd2_replay": "SELECT * FROM customer_versions",
    "scd2_merge_bucketed": "SELECT * FROM policies_history",
    "scd2_late": "SELECT * FROM policies_history",
    "intake_history": """
    SELECT *, md5(policy_id || '|' || cast(dbt_valid_from AS varchar)) AS dbt_scd_id FROM intake_policies_history""",
    "surrogate_key": f"""
    SELECT event_id, {_sk('event_id')} AS one,
           {_sk('user_id', 'CASE WHEN event_id % 3 > 0 THEN c_mktsegment END', 'ts')} AS three
    FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "dim_policies": "SELECT * FROM dim_policies",
    "dim_participants": "SELECT * FROM dim_participants",
    "dim_product": "SELECT * FROM dim_product",
    "dim_date": """
    SELECT d.* EXCLUDE (dbt_run_started_at), count(c.contribution_id) AS n_contributions
    FROM dim_date d LEFT JOIN contributions c ON c.contribution_date = d.date_day GROUP BY ALL""",
    **{f: f"SELECT * FROM {f}" for f in ("fct_contributions", "fct_claims", "fct_agency_commissions")},
    "fct_contributions_by_day": "SELECT * FROM fct_contributions",
    "fct_contributions_mixed": "SELECT * FROM fct_contributions",
    **{
        f"daily_{mart}": f"SELECT *, {LOADED_AT} AS etl_loaded_at FROM daily_{mart}"
        for mart in ("dim_policies", "dim_participants", "fct_contributions", "fct_agency_commissions")
    },
    **{
        f"rebuild_{mart}": f"SELECT * FROM daily_{mart}"
        for mart in ("dim_policies", "dim_participants", "fct_contributions", "fct_claims", "fct_agency_commissions")
    },
    "incremental_fct_contributions": f"""
    SELECT *, {LOADED_AT} AS etl_loaded_at
    FROM ({_asof("contributions", _CONTRIBUTIONS, "contribution_date", "growing_dim_policies")})""",
    "incremental_fct_agency_commissions": f"""
    SELECT *, {LOADED_AT} AS etl_loaded_at
    FROM ({_asof("agency_transactions", _COMMISSIONS, "transaction_date", "growing_dim_policies")})""",
    "run_reconciliation": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS landed, (SELECT count(*) FROM {t}) AS staged, "
        f"(SELECT count(*) FROM daily_{m}) AS published, true AS agrees"
        for t, m in {
            "participants": "dim_participants",
            "policies": "dim_policies",
            "contributions": "fct_contributions",
            "claims": "fct_claims",
            "agency_transactions": "fct_agency_commissions",
        }.items()
    ),
    # A day, or month, is written again if it has new facts, or facts of a key that appears.
    "incremental_rows_written": """
    SELECT run_ts, mart, count(*) AS parts, count(*) FILTER (written) AS parts_written,
           cast(sum(n) AS bigint) AS rows, cast(coalesce(sum(n) FILTER (written), 0) AS bigint) AS rows_written
    FROM (SELECT run_ts, mart, day, n,
                 appears OR n IS DISTINCT FROM lag(n) OVER (PARTITION BY mart, day ORDER BY run_ts) AS written
          FROM (SELECT f.run_ts, f.mart, f.day, count(*) AS n,
                       coalesce(bool_or(s.seen = f.run_ts), false) AS appears
                FROM growing_facts f LEFT JOIN first_seen s USING (key) GROUP BY f.run_ts, f.mart, f.day))
    GROUP BY run_ts, mart""",
    "stg_view_sql": """
    SELECT p.product_category, c.status, count(*) AS claims
    FROM claims c JOIN policies p ON c.policy_id = p.policy_id GROUP BY p.product_category, c.status""",
    "asof_lineitem": """
    SELECT version_status, l_returnflag, count(*) AS items,
           cast(sum(cast(l_extendedprice AS decimal(12,2))) AS decimal(18,2)) AS price
    FROM items_asof GROUP BY ALL""",
    "asof_lineitem_rows": "SELECT l_orderkey, custkey, l_shipdate, l_returnflag, version_status FROM items_asof",
    "run_stamp": f"SELECT {STAMP}, count(*) AS n FROM claims GROUP BY ALL",
    "load_stamp": f"SELECT {LOADED_AT} AS etl_loaded_at, count(*) AS n FROM fct_claims GROUP BY ALL",
    "dq_single_stamp": f"""
    SELECT DISTINCT {RUN_TS} AS stamp FROM fct_contributions UNION ALL
    SELECT DISTINCT {LOADED_AT} FROM fct_contributions""",
    "audit_export_roundtrip": "SELECT * FROM fct_claims",
    "publish_idempotent": "SELECT * FROM fct_agency_commissions",
    "daily_refresh": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, cast({n} AS bigint) AS row_count, cast({m} AS bigint) AS source_count"
        for t, (n, m) in _DAILY.items()
    ),
    "star_fact_view": _star("fct_contributions", "contribution_date"),
    "star_claims_view": _star("fct_claims", "claim_date"),
    "star_commissions_view": _star("fct_agency_commissions", "transaction_date"),
    "star_participants_current": """
    SELECT p.participant_id, p.policy_sk, p.policy_id, p.status, p.is_current, c.full_name, c.state
    FROM dim_policies p LEFT JOIN (SELECT * FROM dim_participants WHERE is_current) c
      ON p.participant_id = c.participant_id""",
    "rpt_row_counts": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {m}) AS row_count,
                   (SELECT count(*) FROM {source}) AS source_count"""
        for t, (m, source) in _COUNTS.items()
    ),
    "rpt_freshness": f"""
    SELECT max(dbt_run_started_at) AS last_run_started_at, max({LOADED_AT}) AS last_loaded_at FROM fct_contributions""",
    "rpt_status": "SELECT status, count(policy_id) AS policies FROM dim_policies GROUP BY status",
    "rpt_fund_by_category": f"""
    SELECT p.product_category, {_FUND_SUMS}
    FROM fct_contributions f LEFT JOIN dim_policies p ON f.policy_sk = p.policy_sk GROUP BY p.product_category""",
    "rpt_claims": """
    SELECT status, fund_type, count(*) AS claims, cast(sum(count(*)) OVER (PARTITION BY status) AS bigint) AS claims_of_status,
           round(count(*) / sum(count(*)) OVER (PARTITION BY status), 6) AS share
    FROM fct_claims GROUP BY status, fund_type""",
    "rpt_fund_split": f"""
    SELECT contribution_id, policy_id, gross_amount, prf_amount, pif_amount, wakalah_fee_shareholders_fund, {_DIFF} AS diff
    FROM x_stg_contributions WHERE abs({_DIFF}) > 0.01""",
    "rpt_leakage": _leakage("x_fct_contributions", "dim_policies", "policy_sk"),
    "trace_fact": f"""
    SELECT contribution_id, policy_id, gross_amount, prf_amount, pif_amount, wakalah_fee_shareholders_fund, {_DIFF} AS diff
    FROM fct_contributions WHERE contribution_id = '42'""",
    "sample_rows": "SELECT * FROM policies ORDER BY policy_id LIMIT 10",
    "fd_check": """
    SELECT 'brand-type' AS dependency, p_brand AS determinant, count(DISTINCT p_type) AS n_values
    FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1
    UNION ALL
    SELECT 'product-category', product_name, count(DISTINCT product_category)
    FROM policies GROUP BY product_name HAVING count(DISTINCT product_category) > 1
    UNION ALL
    SELECT 'agent-branch', agent_id, count(DISTINCT branch)
    FROM policies GROUP BY agent_id HAVING count(DISTINCT branch) > 1""",
    "dq_fund_leakage_staging": _leakage(_LEAKY, "policies", "policy_id"),
    "dq_one_current_strict_dim_policies": _current_strict("x_dim_policies", "policy_id"),
    "dq_one_current_strict_dim_participants": _current_strict("x_dim_participants", "participant_id"),
    "dq_scd_gaps": """
    SELECT policy_id, reach AS gap_from, valid_from AS gap_to FROM (
        SELECT policy_id, valid_from, max(valid_to) OVER (PARTITION BY policy_id ORDER BY valid_from
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
        FROM dim_policies WHERE valid_to >= valid_from + INTERVAL 36 HOUR)
    WHERE reach < valid_from""",
    "dq_suite_summary": _SUMMARY,
    **{f"dq_{name}": sql for name, sql in CHECKS.items()},
}


# Times that may be the end of time are shown as text.
_ENDS_AS_TEXT = {
    **dict.fromkeys(
        ["dim_policies", "dim_participants", "daily_dim_policies", "daily_dim_participants"]
        + ["rebuild_dim_policies", "rebuild_dim_participants"]
        + ["scd2_replay"]
        + [f"dq_not_null_dim_policies_{c}" for c in ("policy_sk", "policy_id")]
        + [f"dq_not_null_dim_participants_{c}" for c in ("participant_sk", "participant_id")],
        ["valid_from", "valid_to"],
    ),
    **dict.fromkeys([f"dq_unique_combination_dim_{d}" for d in ("policies", "participants")], ["valid_from"]),
    **dict.fromkeys(
        [f"dq_no_scd_overlap_dim_{d}" for d in ("policies", "participants")],
        ["a_valid_from", "a_valid_to", "b_valid_from", "b_valid_to"],
    ),
}


def oracle() -> dict[str, str]:
    prelude = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    queries = dict(QUERIES)
    for name, columns in _ENDS_AS_TEXT.items():
        texts = ", ".join(f"cast({c} AS varchar) AS {c}" for c in columns)
        queries[name] = f"SELECT * REPLACE ({texts}) FROM ({queries[name]})"
    return {name: f"WITH {prelude}\n{sql.strip()}" for name, sql in queries.items()}
