"""Source divergence: how the word use of sources of one language differs, by count-level bitmaps.

Terms are counted per (language, source) and those in enough documents of a language kept. Terms are
dealt into chunks by hash and numbered within; per chunk, source and count there is one set of term
numbers, a level. Of two sources, the terms with count a here and b there are the AND of two levels, and
their number its popcount; those a source lacks follow by complement. So a sum over all terms becomes one
over pairs of counts. Levels of few terms are lists of numbers instead of bitmaps, as in compressed
bitmaps, and are looked up in the other's levels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm import tables

#: Fixed value: what a share of one is in whole numbers.
SCALE = 1_000_000_000


@dataclass(frozen=True)
class DivergenceParams:
    """Terms in fewer than ``least_docs`` documents of a language are left out; ``top`` terms are reported
    per source. A chunk holds some ``chunk_rows`` counts; a task sums up to ``held`` before passing them on."""

    least_docs: int = 3
    top: int = 200
    chunk_rows: int = 200_000
    held: int = 300_000


#: Letters of ASCII in lower case and bytes beyond it stay, all else becomes a space.
_TO_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, A to Z in lower case."""
    return text.encode().translate(_TO_TERMS).split()


def count_terms(docs: DataFrame, params: DivergenceParams) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that have the term, summed per task.

    Every group also has a row without a term, which keeps groups that have none."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, source) not in groups:
                    groups[lang, source] = Counter(), Counter()
                n, of = groups[lang, source]
                before = len(n)
                found = terms_of(text)
                n.update(found)
                of.update(set(found))
                held += len(n) - before
                if held > params.held:
                    yield from _counted(groups)
                    groups, held = {}, 0
        yield from _counted(groups)

    partial = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _counted(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, of) in groups.items():
        terms = pa.array([None, *n], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang] * len(terms), pa.string()),
                "source": pa.array([source] * len(terms), pa.string()),
                "term": terms,
                "n": pa.array([0, *n.values()], pa.int64()),
                "docs": pa.array([0, *(of[t] for t in n)], pa.int64()),
            }
        )


def share(count: str, total: str, terms: str) -> Column:
    """Smoothed share in billionths, at least 1. The product is a decimal: it can exceed 64 bits."""
    product = f"cast({count} + 1 AS decimal(19,0)) * {SCALE}"
    return F.expr(f"1 + ({product}) div cast({total} + {terms} AS decimal(19,0))")


def shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same of an array of counts."""
    return np.array([1 + SCALE * (n + 1) // (total + terms) for n in count.tolist()], np.int64)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


@dataclass
class Levels:
    """Terms of one source in a chunk, by count: dense levels as bitmaps, the others as sorted numbers."""

    counts: np.ndarray
    sizes: np.ndarray
    dense: np.ndarray  # which levels are bitmaps
    bits: np.ndarray  # a row per dense level
    numbers: np.ndarray  # terms of the other levels, sorted, and the level of each
    level: np.ndarray

    def find(self, numbers: np.ndarray) -> np.ndarray:
        """The level of each term, or -1."""
        out = np.full(len(numbers), -1)
        if len(self.numbers):
            at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
            out = np.where(self.numbers[at] == numbers, self.level[at], out)
        if len(self.dense):
            byte = self.bits.view(np.uint8)[:, numbers >> 3]
            has = byte >> (numbers & 7).astype(np.uint8) & 1
            out = np.where(has.any(axis=0), self.dense[has.argmax(axis=0)], out)
        return out


LEVEL = "lang string, chunk long, terms long, source string, n long, size long, dense boolean, members binary"


def make_levels(chunk: pa.Table) -> pa.Table:
    """Number the terms of a chunk and gather them by source and count."""
    lang, at = chunk["lang"][0], chunk["chunk"][0]
    encoded = chunk["term"].combine_chunks().dictionary_encode()
    terms, number = len(encoded.dictionary), encoded.indices.to_numpy().astype(np.int64)
    sources = chunk["source"].combine_chunks().dictionary_encode()
    source, n = sources.indices.to_numpy().astype(np.int64), chunk["n"].to_numpy()
    order = np.lexsort((number, n, source))
    source, n, number = source[order], n[order], number[order].astype(np.uint32)
    opens = np.flatnonzero(np.append(True, (source[1:] != source[:-1]) | (n[1:] != n[:-1])))
    members, dense = [], []
    for begin, end in zip(opens, np.append(opens[1:], len(n))):
        dense.append(32 * (end - begin) >= terms)  # then a bitmap is no larger than the list
        if dense[-1]:
            flags = np.zeros(-(-terms // 64) * 64, np.uint8)
            flags[number[begin:end]] = 1
            members.append(np.packbits(flags, bitorder="little").tobytes())
        else:
            members.append(number[begin:end].tobytes())
    rows = len(opens)
    return pa.table(
        {
            "lang": pa.array([lang.as_py()] * rows, pa.string()),
            "chunk": pa.array([at.as_py()] * rows, pa.int64()),
            "terms": pa.array([terms] * rows, pa.int64()),
            "source": sources.dictionary.take(pa.array(source[opens])).cast(pa.string()),
            "n": pa.array(n[opens], pa.int64()),
            "size": pa.array(np.diff(np.append(opens, len(n))), pa.int64()),
            "dense": pa.array(dense, pa.bool_()),
            "members": pa.array(members, pa.binary()),
        }
    )


def read_levels(rows: list[dict], terms: int) -> Levels:
    words = -(-terms // 64)
    dense = np.array([i for i, r in enumerate(rows) if r["dense"]], np.int64)
    bits = np.frombuffer(b"".join(rows[i]["members"] for i in dense), np.uint64).reshape(len(dense), words)
    listed = [(i, np.frombuffer(r["members"], np.uint32)) for i, r in enumerate(rows) if not r["dense"]]
    numbers = np.concatenate([np.zeros(0, np.uint32), *(x for _, x in listed)]).astype(np.int64)
    level = np.repeat(np.array([i for i, _ in listed], np.int64), [len(x) for _, x in listed])
    order = np.argsort(numbers)
    counts, sizes = (np.array([r[c] for r in rows], np.int64) for c in ("n", "size"))
    return Levels(counts, sizes, dense, bits, numbers[order], level[order])


def joint_cells(a: Levels, b: Levels) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(level of a, level of b, terms)`` of the terms both have."""
    parts = []
    for i, bits in zip(a.dense, a.bits):
        both = np.bitwise_count(bits & b.bits).sum(axis=1, dtype=np.int64)
        parts.append((np.full(len(both), i), b.dense, both))
    there = b.find(a.numbers)
    parts.append((a.level[there >= 0], there[there >= 0], np.ones((there >= 0).sum(), np.int64)))
    # Terms in lists of b and bitmaps of a; those in lists of both are counted already.
    here = a.find(b.numbers)
    bitmap = np.isin(here, a.dense)
    parts.append((here[bitmap], b.level[bitmap], np.ones(bitmap.sum(), np.int64)))
    i, j, n = (np.concatenate(x) for x in zip(*parts))
    width = len(b.counts) + 1
    cell, of = np.unique(i * width + j, return_inverse=True)
    total = np.bincount(of, n, len(cell)).astype(np.int64)
    return cell[total > 0] // width, cell[total > 0] % width, total[total > 0]


def pair_sums(levels: pa.Table, groups: pa.Table) -> pa.Table:
    """Summed gaps of all ordered pairs of a language's sources over the terms of one chunk."""
    rows: dict[str, list[dict]] = {}
    for r in levels.to_pylist():
        rows.setdefault(r["source"], []).append(r)
    terms = levels["terms"][0].as_py() if len(levels) else 0
    named = sorted(groups.to_pylist(), key=lambda g: g["source"])
    read = {g["source"]: read_levels(rows.get(g["source"], []), terms) for g in named}
    zero, own = {}, {}
    for g in named:
        zero[g["source"]] = shares(np.zeros(1, np.int64), g["total"], g["terms"])[0]
        own[g["source"]] = shares(read[g["source"]].counts, g["total"], g["terms"])
    out: dict[str, list] = {"source": [], "item": [], "value": []}
    for k, x in enumerate(read):
        for y in list(read)[:k]:
            a, b = read[x], read[y]
            i, j, n = joint_cells(a, b)
            only_a = a.sizes - np.bincount(i, n, len(a.sizes)).astype(np.int64)
            only_b = b.sizes - np.bincount(j, n, len(b.sizes)).astype(np.int64)
            neither = terms - int(a.sizes.sum()) - int(only_b.sum())
            p, q, p0, q0 = own[x], own[y], zero[x], zero[y]
            for source, item, f in ((x, y, gap), (y, x, lambda p, q: gap(q, p))):
                value = (n * f(p[i], q[j])).sum() + (only_a * f(p, q0)).sum() + (only_b * f(p0, q)).sum()
                for name, v in (("source", source), ("item", item), ("value", int(value + neither * f(p0, q0)))):
                    out[name].append(v)
    lang = groups["_lang"][0].as_py() if len(groups) else ""
    kinds = {"source": pa.string(), "item": pa.string(), "value": pa.int64()}
    columns = {"lang": pa.array([lang] * len(out["value"]), pa.string())}
    return pa.table(columns | {name: pa.array(out[name], kind) for name, kind in kinds.items()})


def source_divergence(docs: DataFrame, params: DivergenceParams = DivergenceParams()) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every language and source.

    Part ``pair``: the other sources of the language by divergence from them, all of them; over all kept
    terms it sums ``(p - q)^2 div q``, where p and q are the smoothed shares of a term here and there. Part
    ``term``: the ``top`` terms used more here than in the language as a whole, q its share there. Ties are
    ordered by the bytes of the item. NULL text, language or source count as ''. Repeated rows are documents
    of their own. A source without terms, or a language that keeps none, still has its pairs (0 without
    kept terms). An empty table gives none; other columns are not read.
    """
    work = tables.Workspace(docs.sparkSession)
    counts = work.store(count_terms(docs, params))
    terms = counts.filter("term IS NOT NULL")
    of_lang = terms.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
    kept = work.store(of_lang.filter(F.col("docs") >= params.least_docs).drop("docs"))
    used = work.store(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all_n"))

    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("all_total"))
    langs = langs.join(used.groupBy("lang").agg(F.count("*").alias("_rows")), "lang")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left")
    groups = work.store(groups.join(langs, "lang", "left").fillna(0, ["total", "terms", "all_total", "_rows"]))

    pairs, found = _pairs(work, used, groups, params), _terms(used, groups)
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(by_value)) for df in (pairs, found)]
    top = ranked[1].filter(F.col("rank") <= params.top)
    return ranked[0].unionByName(top).select("lang", "source", "part", "item", "value", "rank")


def _pairs(work: tables.Workspace, used: DataFrame, groups: DataFrame, params: DivergenceParams) -> DataFrame:
    langs = groups.select("lang", F.expr(f"_rows div {params.chunk_rows} + 1").alias("_chunks")).distinct()
    chunk = F.pmod(F.xxhash64("term"), F.col("_chunks")).alias("chunk")
    dealt = used.join(langs, "lang").select("lang", chunk, "source", "term", "n")
    levels = work.store(dealt.groupBy("lang", "chunk").applyInArrow(make_levels, LEVEL))
    sources = groups.select("lang", "source", "total", "terms")
    chunks = levels.select("lang", F.col("chunk").alias("_chunk")).distinct().join(sources, "lang")
    chunks = chunks.withColumnRenamed("lang", "_lang")
    both = levels.groupBy("lang", "chunk").cogroup(chunks.groupBy("_lang", "_chunk"))
    sums = both.applyInArrow(pair_sums, "lang string, source string, item string, value long")
    # Languages without kept terms have no chunk.
    bare = groups.filter("terms = 0").select("lang", "source")
    others = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    sums = sums.unionByName(others.select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    total = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return total.withColumn("part", F.lit("pair"))


def _terms(used: DataFrame, groups: DataFrame) -> DataFrame:
    shared = used.join(groups.drop("_rows"), ["lang", "source"]).select(
        "lang",
        "source",
        F.col("term").alias("item"),
        share("n", "total", "terms").alias("p"),
        share("all_n", "all_total", "terms").alias("q"),
    )
    value = F.expr("(p - q) * (p - q) div q").alias("value")
    return shared.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", value)


def oracle_sql() -> str:
    """The same over ``documents``, with the default parameters, by joining counts of terms."""
    share = f"1 + ({SCALE}::HUGEINT * ({{}} + 1)) // ({{}} + {{}})"
    gap = "((p - q) * (p - q)) // q"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
               FROM documents),
    found AS (SELECT doc, lang, source,
                     unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    per_doc AS (SELECT doc, lang, source, term, count(*) AS n FROM found GROUP BY ALL),
    kept AS (SELECT lang, term, sum(n) AS n FROM per_doc GROUP BY lang, term HAVING count(*) >= 3),
    langs AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM kept GROUP BY lang),
    used AS (SELECT lang, source, term, sum(n) AS n FROM per_doc SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT lang, source, coalesce(sum(n), 0) AS total
               FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN used USING (lang, source) GROUP BY ALL),
    cells AS (SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
                     {share.format("coalesce(u.n, 0)", "g.total", "l.terms")} AS p,
                     {share.format("k.n", "l.total", "l.terms")} AS q
              FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
              LEFT JOIN used u ON g.lang = u.lang AND g.source = u.source AND k.term = u.term),
    sums AS (SELECT lang, source, item, sum({gap}) AS value
             FROM (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q
                   FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source)
             GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
              FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, {gap} AS value FROM cells WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, cast(value AS bigint) AS value, cast(rank AS integer) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
          FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    WHERE part = 'pair' OR rank <= 200"""
