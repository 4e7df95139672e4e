"""Typed raw tables that tolerate values of the wrong type, and say which."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, IntegerType, StringType, StructType

#: Column of a raw table with the cells that couldn't be typed.
REJECTS = "rejects"
_REJECT = "array<struct<column_name: string, value: string, reason: string>>"


def load_raw(df: DataFrame, schema: StructType) -> DataFrame:
    """Type a text frame: a date that can't be parsed becomes NULL, any other bad value raises."""
    return df.select(
        *[
            F.col(f.name).try_cast(f.dataType).alias(f.name)
            if isinstance(f.dataType, DateType)
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_raw(df: DataFrame, schema: StructType, path: str) -> None:
    """Replace a raw table by a fresh load."""
    load_raw(df, schema).write.mode("overwrite").parquet(path)


def load_tolerant(df: DataFrame, schema: StructType) -> DataFrame:
    """Type a text frame without raising: a value that can't be typed becomes NULL and is kept in ``rejects``.

    ``rejects`` is empty for a clean row. '' and NULL are no values, so they aren't rejected; a column that
    ``df`` lacks is NULL. One projection: typed rows and rejects come from the same pass."""
    present = {name.lower() for name in df.columns}
    typed, bad = [], []
    for f in schema.fields:
        if f.name.lower() not in present:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.nullif(F.trim(f.name), F.lit(""))
        value = F.col(f.name) if isinstance(f.dataType, StringType) else text.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        if not isinstance(f.dataType, StringType):
            reject = F.struct(
                F.lit(f.name).alias("column_name"), F.col(f.name).alias("value"), _reason(text, f.dataType).alias("reason")
            )
            bad.append(F.when(text.isNotNull() & value.isNull(), reject))
    found = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array()
    return df.select(*typed, found.cast(_REJECT).alias(REJECTS))


def _reason(text: Column, kind: DataType) -> Column:
    """Why a value can't be typed: what it isn't, or that it is a number the type can't hold."""
    number = text.try_cast("double")
    if isinstance(kind, DateType):
        like = text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
        return F.when(like, "no such day").otherwise("not a date")
    if isinstance(kind, BooleanType):
        return F.lit("not a boolean")
    if isinstance(kind, IntegerType):
        whole = number == F.floor(number)
        return F.when(number.isNull() | F.isnan(number), "not a number").when(whole, "out of range").otherwise("not whole")
    if isinstance(kind, DecimalType):
        return F.when(number.isNull() | F.isnan(number), "not a number").otherwise("out of range")
    return F.lit(f"not of type {kind.simpleString()}")


def write_tolerant(df: DataFrame, schema: StructType, path: str) -> None:
    """Replace a raw table by a fresh load that keeps, in ``rejects``, what couldn't be typed."""
    load_tolerant(df, schema).write.mode("overwrite").parquet(path)


def read_rejects(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``key, column_name, value, reason``: a row per cell that couldn't be typed.

    Reads two columns of the table; rows without rejects are left out by Parquet's statistics or at once."""
    rows = spark.read.parquet(path).select(key, REJECTS).filter(F.size(REJECTS) > 0)
    return rows.select(key, F.inline(REJECTS))
