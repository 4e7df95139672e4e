"""Run named queries in Spark and their oracle in DuckDB, compare as multisets."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return round(value, 6)
    return value


def multiset(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_result(df):
    return multiset(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(con, sql):
    result = con.execute(sql)
    return multiset([d[0] for d in result.description], result.fetchall())
