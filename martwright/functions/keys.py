"""Hashed keys and null-safe comparison, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: Column | str) -> Column:
    """md5 of the fields as text, joined by ``-``, NULL replaced by a marker."""
    fields = [F.coalesce(_column(c).cast("string"), F.lit(NULL_MARKER)) for c in columns]
    return F.md5(F.concat_ws("-", *fields))


def version_id(key: Column | str, valid_from: Column | str) -> Column:
    """md5 identifying one version in a history."""
    fields = [F.coalesce(_column(c).cast("string"), F.lit("")) for c in (key, valid_from)]
    return F.md5(F.concat_ws("|", *fields))


def any_distinct(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True if any pair differs; NULL equals NULL, and the result is never NULL."""
    return reduce(lambda a, b: a | b, (~left.eqNullSafe(right) for left, right in pairs), F.lit(False))


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
