"""Column lists and types of the sources, the histories and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, DATE, BOOLEAN, INTEGER = StringType(), DateType(), BooleanType(), IntegerType()
TIMESTAMP = TimestampNTZType()
MONEY, RATE = DecimalType(12, 2), DecimalType(5, 2)


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Names, order and types of the five sources.
SOURCES = {
    "participants": _struct(
        participant_id=STRING,
        full_name=STRING,
        ic_number=STRING,
        date_of_birth=DATE,
        gender=STRING,
        state=STRING,
        join_date=DATE,
    ),
    "policies": _struct(
        policy_id=STRING,
        participant_id=STRING,
        product_name=STRING,
        product_category=STRING,
        has_pif=BOOLEAN,
        start_date=DATE,
        end_date=DATE,
        term_years=INTEGER,
        payment_mode=STRING,
        contribution_amount=MONEY,
        status=STRING,
        agent_id=STRING,
        branch=STRING,
    ),
    "contributions": _struct(
        contribution_id=STRING,
        policy_id=STRING,
        contribution_date=DATE,
        gross_amount=MONEY,
        wakalah_fee_shareholders_fund=MONEY,
        prf_amount=MONEY,
        pif_amount=MONEY,
        payment_method=STRING,
    ),
    "claims": _struct(
        claim_id=STRING,
        policy_id=STRING,
        claim_type=STRING,
        claim_date=DATE,
        claim_amount=MONEY,
        fund_type=STRING,
        status=STRING,
        approval_date=DATE,
    ),
    "agency_transactions": _struct(
        transaction_id=STRING,
        agent_id=STRING,
        policy_id=STRING,
        transaction_type=STRING,
        transaction_date=DATE,
        commission_rate=RATE,
        commission_amount_shareholders_fund=MONEY,
    ),
}

# Names, order and types of the seven marts, as published.
_STAMPS = {"dbt_run_started_at": TIMESTAMP, "etl_loaded_at": TIMESTAMP}
_VERSION = {"valid_from": TIMESTAMP, "valid_to": TIMESTAMP, "is_current": BOOLEAN}

MARTS = {
    "dim_policies": _struct(
        policy_sk=STRING,
        policy_id=STRING,
        participant_id=STRING,
        product_name=STRING,
        product_category=STRING,
        has_pif=BOOLEAN,
        start_date=DATE,
        end_date=DATE,
        term_years=INTEGER,
        payment_mode=STRING,
        status=STRING,
        agent_id=STRING,
        contribution_amount=MONEY,
        **_VERSION,
        **_STAMPS,
    ),
    "dim_participants": _struct(
        participant_sk=STRING,
        participant_id=STRING,
        full_name=STRING,
        ic_number=STRING,
        state=STRING,
        date_of_birth=DATE,
        gender=STRING,
        join_date=DATE,
        **_VERSION,
        **_STAMPS,
    ),
    "dim_product": _struct(product_sk=STRING, product_name=STRING, product_category=STRING, **_STAMPS),
    "dim_date": _struct(
        date_day=DATE,
        year=INTEGER,
        quarter=INTEGER,
        month=INTEGER,
        month_name=STRING,
        day_of_month=INTEGER,
        day_of_week=INTEGER,
        day_name=STRING,
        is_weekend=BOOLEAN,
        **_STAMPS,
    ),
    "fct_contributions": _struct(
        contribution_id=STRING,
        policy_id=STRING,
        policy_sk=STRING,
        contribution_date=DATE,
        gross_amount=MONEY,
        prf_amount=MONEY,
        pif_amount=MONEY,
        wakalah_fee_shareholders_fund=MONEY,
        payment_method=STRING,
        **_STAMPS,
    ),
    "fct_claims": _struct(
        claim_id=STRING,
        policy_id=STRING,
        policy_sk=STRING,
        claim_type=STRING,
        claim_date=DATE,
        claim_amount=MONEY,
        fund_type=STRING,
        status=STRING,
        approval_date=DATE,
        **_STAMPS,
    ),
    "fct_agency_commissions": _struct(
        transaction_id=STRING,
        agent_id=STRING,
        policy_id=STRING,
        policy_sk=STRING,
        transaction_type=STRING,
        transaction_date=DATE,
        commission_rate=RATE,
        commission_amount_shareholders_fund=MONEY,
        **_STAMPS,
    ),
}

# Text widths of the serving tables, for the JDBC target.
TEXT_WIDTHS = {
    "policy_sk": 64,
    "participant_sk": 64,
    "product_sk": 64,
    "product_name": 100,
    "product_category": 20,
    "full_name": 200,
    "state": 50,
    "gender": 1,
    "claim_type": 50,
    "fund_type": 10,
    "payment_method": 30,
}
DEFAULT_TEXT_WIDTH = 20
# Columns of the serving tables that hold text of any script.
NATIONAL_TEXTS = {
    "claim_type",
    "full_name",
    "payment_method",
    "payment_mode",
    "product_category",
    "product_name",
    "state",
    "status",
    "transaction_type",
}

# Columns of a history beside those of its source.
VALID_FROM, VALID_TO, VERSION_ID = "dbt_valid_from", "dbt_valid_to", "dbt_scd_id"
#: True on the first version of a key. Set when the version is written, because finding it
#: later takes a shuffle of the whole history.
FIRST_VERSION = "is_first_version"

HISTORY_COLUMNS = _struct(
    **{VALID_FROM: TIMESTAMP, VALID_TO: TIMESTAMP, VERSION_ID: STRING, FIRST_VERSION: BOOLEAN}
)


def history_schema(source: str) -> StructType:
    return StructType(SOURCES[source].fields + HISTORY_COLUMNS.fields)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema``, in its order, cast once; a column the input lacks is NULL.

    With ANSI casts a malformed value raises instead of turning into NULL.
    """
    present = {name.lower() for name in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def as_mart(df: DataFrame, mart: str) -> DataFrame:
    """Project to the published columns of ``mart``, without the load stamp."""
    return conform(df, StructType([f for f in MARTS[mart].fields if f.name != "etl_loaded_at"]))
