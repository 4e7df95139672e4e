"""URL filters: pattern rules, found by their rarest literal token.

A rule is a regular expression over ``host + path`` with the tokens that any URL it fits must hold.
Over all URLs the tokens of the rules are counted, and each rule is indexed by its rarest one. The
tokens of a URL fetch its candidate rules by an equi join, and only those run their expression. A
rule without a token is a candidate for every URL, by a token that every URL is given.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of hosts and paths, as (verdict, rule).
HOST_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# Patterns that block a URL which no rule of host and path decides, with the token
# that a URL must hold to fit.
PATTERNS = [
    (r"(^|[./_-])cheap-pills([./_-]|$)", "pills"),
    (r"(^|[./_-])spam-farm([./_-]|$)", "spam"),
    (r"(^|[./_-])casino([./_-]|$)", "casino"),
    (r"(^|[./_-])porn([./_-]|$)", "porn"),
    (r"(^|[./_-])(free|win)-iphone([./_-]|$)", "iphone"),
    (r"(^|[./_-])payday-loans?([./_-]|$)", "payday"),
]

_EVERY = "*"
_PARTS = r"[^0-9A-Za-z\x80-\x{10FFFF}]+"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; where several rules fit, the highest ``rank`` decides."""

    name: str | None
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def host_rule(verdict: str, rule: str) -> Rule:
    """A rule for a host with its subdomains and for paths with a prefix; the longest rule wins.

    All but the last token must stand whole in the URL; the last may go on there, unless a
    separator ends the rule.
    """
    host, slash, path = rule.partition("/")
    pattern = rf"^([^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    tokens = [t for t in re.split(r"[^0-9A-Za-z\x80-\U0010ffff]+", rule)]
    return Rule(rule, verdict, pattern, tuple(t for t in tokens[:-1] if t), 1_000 + len(rule))


def pattern_rule(pattern: str, token: str, verdict: str = "block") -> Rule:
    return Rule(None, verdict, pattern, (token,), 0)


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(*p) for p in PATTERNS]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, in lower case for A to Z, and path; both '' for NULL or a URL without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict``, one row per row of ``pages``.

    Distinct places ``host + path`` are judged once. ``rule`` names the rule of host and path that
    decided; it is NULL where a pattern or the default did. Of equal ranks the rule that comes first
    in the list decides. Repeated rows stay repeated, a NULL id stays NULL, and a URL without a host
    gets the default; no rows give no rows.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    place = F.concat("host", "path")
    listed = spark.createDataFrame(
        [(i, r.name, r.verdict, r.pattern, r.rank, list(r.tokens) or [_EVERY]) for i, r in enumerate(rules)],
        "rule_no int, rule string, verdict string, pattern string, rank int, tokens array<string>",
    )
    places = rows.filter("host <> ''").select(place.alias("place")).distinct()
    tokens = F.array_append(F.array_distinct(F.filter(F.split("place", _PARTS), lambda t: t != "")), F.lit(_EVERY))
    found = places.select("place", F.explode(tokens).alias("token"))

    needed = listed.select(F.explode("tokens").alias("token"), "rule_no")
    counts = found.join(needed.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarity = needed.join(counts, "token", "left").fillna(0, ["count"])
    rarest = rarity.groupBy("rule_no").agg(F.min(F.struct("count", "token"))["token"].alias("token"))
    index = listed.drop("tokens").join(rarest, "rule_no")

    fits = found.join(index, "token").filter(F.expr("regexp_like(place, pattern)"))
    order = F.struct(F.col("rank"), -F.col("rule_no"))
    best = fits.groupBy("place").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    # Rows without a host have nothing to look up; their own key spreads them over the tasks.
    nowhere = F.concat(F.lit(" "), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    keyed = rows.withColumn("place", F.when(F.col("host") == "", nowhere).otherwise(place))
    return keyed.join(best, "place", "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def oracle_sql(rules: list[Rule] | None = None, default: str = "allow") -> str:
    """The same in DuckDB's SQL, with every rule tried on every URL."""
    quoted = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
    values = ", ".join(
        f"({i}, {quoted(r.name)}, {quoted(r.verdict)}, {quoted(r.pattern)}, {r.rank})"
        for i, r in enumerate(rules or default_rules())
    )
    return f"""
        WITH rules(rule_no, rule, verdict, pattern, rank) AS (VALUES {values}),
        rest AS (
            SELECT row_number() OVER () AS n, page_id,
                CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
            FROM pages),
        parts AS (
            SELECT n, page_id,
                coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
            FROM rest),
        best AS (
            SELECT n, arg_max(rule_no, rank * 1000 - rule_no) AS rule_no
            FROM parts JOIN rules ON host <> '' AND regexp_matches(host || path, pattern)
            GROUP BY n)
        SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict
        FROM parts LEFT JOIN best USING (n) LEFT JOIN rules USING (rule_no)
    """
