import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"

ODD = [(None, "no id. a text without an id."), (7, None), (8, ""), (9, " \n\t"), (10, "x"), (10, "x"), (11, "word " * 30_000)]


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs, empty and very long texts, a repeated row, and a column with a clashing name."""
    schema = "doc_id long, text string, `key` int, rank string, toxicity int, leaks int, spans int, print int"
    return spark.createDataFrame([(*r, 1, "r", 2, 3, 4, 5) for r in ODD], schema)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
