"""Every named query gives what its SQL oracle gives."""

from datetime import datetime

import compare
import pytest

import __spark_entry__ as entry
from catalog.oracle import oracle
from catalog.queries import registry
from conftest import SMALL

QUERIES, ORACLE = registry(), oracle()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, small, duck):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns, rows = compare.spark_result(df)
    # A client that counts nanoseconds ends in 2262.
    assert all(v.year < 2262 for row in rows for v in row if isinstance(v, datetime))
    expected_columns, expected = compare.oracle_result(duck, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["product_category", "status"]
    assert df.count() > 0
