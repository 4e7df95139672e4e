"""Mixing sources to target weights: exact block quotas split over shards by a hypergeometric tree.

The documents of a source, in the order of a hash, are a sequence of words, passed over up to three
times; its target cuts the sequence off, and what is left falls into blocks of equal numbers of words. The
blocks of all sources are dealt to output shards by a tree: a node holds how many blocks of each source its
shards get in all, and draws the share of its first half from the multivariate hypergeometric
distribution, until a node is one shard. So every shard has a random mix, no block is drawn twice and the
quotas of all shards add up exactly. Shard after shard takes the next blocks of each source in a keyed
permutation, and shuffles the documents that begin in its blocks.

Numbers, not tasks, decide: the draw of a node depends on the seed and its shards only, and a position on
hashes only, so a lost executor or another partitioning changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm import tables, words


@dataclass(frozen=True)
class MixParams:
    """Sources weigh ``weights`` in turn; none is taken more than ``most_passes`` times.

    A block has ``block_words`` words, a shard some ``shard_blocks`` blocks. A task places ``part_rows``
    documents and expands ``depth`` levels of the tree."""

    weights: tuple[int, ...] = (5, 2, 1)
    most_passes: int = 3
    block_words: int = 1 << 14
    shard_blocks: int = 64
    part_rows: int = 100_000
    depth: int = 6
    seed: int = 17


def with_sizes(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and the number of words of ``text``, parted by ASCII white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.zeros(0, np.int64)]
            sizes += [np.diff(words.find_words(data, places).first) for _, _, data, places in words.blocks(batch)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(sizes), pa.int64())], [*batch.schema.names, name]
            )

    return docs.mapInArrow(run, tables.arrow_fields(docs, f"`{name}` long"))


def row_key(docs: DataFrame, seed: int) -> Column:
    """Hash of a whole row; rows with the same one are interchangeable."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x1e")) for c in docs.columns]
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *fields))


def running_sums(
    work: tables.Workspace, df: DataFrame, order: list[Column], sums: dict[str, Column], part_rows: int
) -> DataFrame:
    """``df`` with, per name in ``sums``, the sum of an expression over all rows before, in global order.

    Rows are dealt by ranges of ``order`` and summed per part; the sums of parts, one row each, are
    summed in one task. Equal rows are parted by a salt, which may put either first."""
    parts = max(1, -(-df.count() // part_rows))
    order = [*order, F.xxhash64(F.monotonically_increasing_id())]
    keys = [f"_order{i}" for i in range(len(order))]
    keyed = df.withColumns(dict(zip(keys, order)))
    by = [F.asc_nulls_last(k) for k in keys]
    dealt = work.store(keyed.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()))
    totals = dealt.groupBy("_part").agg(*[F.sum(e).alias(f"_all_{n}") for n, e in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("long")
    starts = work.store(
        totals.select("_part", *[F.coalesce(F.sum(f"_all_{n}").over(before), nothing).alias(f"_all_{n}") for n in sums])
    )
    within = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.select("*", *[F.coalesce(F.sum(e).over(within), nothing).alias(f"_own_{n}") for n, e in sums.items()])
    out = placed.join(starts, "_part")
    return out.select(*df.columns, *[(F.col(f"_own_{n}") + F.col(f"_all_{n}")).alias(n) for n in sums])


def targets(work: tables.Workspace, sources: DataFrame, params: MixParams) -> DataFrame:
    """``source, source_size, before, rank, target`` from ``source, source_size``.

    Weights follow the order of names, NULL last. A source gets its weight's share of all words, at most
    ``most_passes`` times its own; what is beyond goes to the others by weight, until none is above."""
    sums = {"before": F.col("source_size"), "rank": F.lit(1).cast("long")}
    placed = running_sums(work, sources, [F.col("source")], sums, params.part_rows)
    weight = F.element_at(F.array(*[F.lit(w) for w in params.weights]), (F.col("rank") % len(params.weights) + 1).cast("int"))
    weighed = work.store(placed.withColumn("weight", weight))
    most = params.most_passes * F.col("source_size")
    total, weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    level, before = (total or 0) / (weights or 1), None
    while level != before:  # each round more sources reach their limit, until none does
        full = most < F.lit(level) * F.col("weight")
        taken, left = weighed.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        level, before = ((total or 0) - (taken or 0)) / left if left else level, level
    full = most < F.lit(level) * F.col("weight")
    target = F.when(full, most.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return weighed.withColumn("target", target).drop("weight")


NODE = "low long, high long, rank long, first long, blocks long"


def expand(node: pa.Table, blocks: int, shards: int, depth: int, seed: int) -> pa.Table:
    """A node of the tree, ``depth`` levels below it: of each source its first block and how many."""
    order = np.argsort(node["rank"].to_numpy())
    rank, first, count = (node[c].to_numpy()[order] for c in ("rank", "first", "blocks"))
    waiting, out = [(node["low"][0].as_py(), node["high"][0].as_py(), first, count, depth)], []
    while waiting:
        low, high, first, count, levels = waiting.pop()
        some = np.flatnonzero(count)
        if high - low == 1 or not levels:
            out.append((np.full(len(some), low), np.full(len(some), high), rank[some], first[some], count[some]))
            continue
        middle = (low + high) // 2
        slots = blocks * middle // shards - blocks * low // shards
        drawn = draw(count, slots, np.random.default_rng([seed, low, high]))
        waiting.append((low, middle, first, drawn, levels - 1))
        waiting.append((middle, high, first + drawn, count - drawn, levels - 1))
    columns = [np.concatenate(x) for x in zip(*out)]
    return pa.table([pa.array(x, pa.int64()) for x in columns], ["low", "high", "rank", "first", "blocks"])


def draw(count: np.ndarray, slots: int, rng: np.random.Generator) -> np.ndarray:
    """``slots`` blocks from an urn of ``count`` of each kind, without putting back: kind after kind."""
    out, left = np.zeros(len(count), np.int64), int(count.sum())
    for i in np.flatnonzero(count):
        left -= int(count[i])
        out[i] = rng.hypergeometric(int(count[i]), left, slots) if slots else 0
        slots -= int(out[i])
    return out


def permuted(places: np.ndarray, size: int, key: int) -> np.ndarray:
    """Images of ``places`` under a permutation of ``0 .. size - 1``: four rounds of mixing one half of the
    bits into the other, again for what falls outside."""
    half = np.uint64(max(1, -(-(size - 1).bit_length() // 2)))
    mask, out = (np.uint64(1) << half) - np.uint64(1), places.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        high, low = out[todo] >> half, out[todo] & mask
        for turn in range(4):
            mixed = words.mix(low + words.mix(np.array([key * 4 + turn + 1], np.uint64)))
            high, low = low, high ^ mixed & mask
        out[todo] = high << half | low
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def deal_blocks(work: tables.Workspace, quotas: DataFrame, params: MixParams) -> DataFrame:
    """``rank, block, shard`` of every block; ``quotas`` has ``rank, blocks`` per source."""
    total = quotas.agg(F.sum("blocks")).first()[0] or 0
    if total > 10**9:
        raise ValueError(f"{total} blocks; choose a larger block_words")
    shards = max(1, -(-total // params.shard_blocks))
    depth, seed = params.depth, params.seed
    zero = F.lit(0).cast("long")
    nodes = quotas.select(zero.alias("low"), F.lit(shards).cast("long").alias("high"), "rank", zero.alias("first"), "blocks")
    for _ in range(max(1, -(-(shards - 1).bit_length() // depth))):
        split = nodes.groupBy("low", "high").applyInArrow(lambda node: expand(node, total, shards, depth, seed), NODE)
        former, nodes = nodes, work.store(split)
        work.drop(former)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, rank, first, blocks, size in zip(*(c.to_pylist() for c in batch.columns)):
                block = permuted(np.arange(first, first + blocks), size, seed * 1_000_003 + rank)
                yield pa.RecordBatch.from_pydict(
                    {"rank": pa.array([rank] * blocks, pa.int64()), "block": block, "shard": pa.array([shard] * blocks, pa.int64())}
                )

    sized = nodes.join(quotas.withColumnRenamed("blocks", "_size"), "rank")
    leaves = sized.select(F.col("low").alias("shard"), "rank", "first", "blocks", "_size")
    return leaves.mapInArrow(explode, "rank long, block long, shard long")


@dataclass
class Mix:
    """``placed``: a row per document, with ``row``, its columns but the text, ``size``, ``source_size`` and ``target``.
    ``draws``: a row per time a document is taken, with ``row, key, pass, words, block, shard, place``."""

    placed: DataFrame
    draws: DataFrame


def mix(docs: DataFrame, params: MixParams = MixParams()) -> Mix:
    """Which documents a mix takes how often, and where they stand in it.

    All documents are taken whole but the last of a source's sequence, of which ``words`` says how many
    words are taken, so each source gives the words of its target, rounded down. Documents without words
    (NULL or empty text) are never drawn. A NULL source is one of its own, ordered last; ids may be NULL or
    repeat; rows equal in all columns are interchangeable. An empty table gives none.
    """
    work = tables.Workspace(docs.sparkSession)
    narrow = docs.select("doc_id", "source", row_key(docs, params.seed).alias("key"), "text")
    sized = work.store(with_sizes(narrow, "size").drop("text"))
    sources = work.store(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    aims = work.store(targets(work, sources, params))
    order = [F.col("source"), F.col("key")]
    rows = running_sums(work, sized, order, {"start": F.col("size"), "row": F.lit(1).cast("long")}, params.part_rows)
    rows = rows.withColumnRenamed("source", "_source").join(aims, F.col("_source").eqNullSafe(F.col("source")))
    placed = work.store(rows.withColumn("start", F.col("start") - F.col("before")).drop("_source", "before"))
    work.drop(sized)

    limit = F.floor("target").cast("long")
    quotas = work.store(aims.select("rank", F.ceil(limit / params.block_words).cast("long").alias("blocks")).filter("blocks > 0"))
    dealt = work.store(deal_blocks(work, quotas, params))
    passes = F.explode(F.sequence(F.lit(0), F.lit(params.most_passes - 1))).alias("pass")
    at = F.col("start") + F.col("pass") * F.col("source_size")
    taken = F.least(F.col("size"), limit - F.col("at"))
    drawn = placed.select("*", passes).withColumn("at", at).withColumn("words", taken).filter("words > 0")
    drawn = drawn.withColumn("block", F.expr(f"at div {params.block_words}"))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(params.seed), "row", "pass"), "row", "pass")
    draws = drawn.join(dealt, ["rank", "block"]).withColumn("place", F.row_number().over(local).cast("long") - 1)
    return Mix(placed, draws.select("row", "key", "pass", "words", "rank", "block", "shard", "place"))


def mixed_documents(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is drawn, with their ``shard`` and ``place`` in it, the
    text of a source's last document cut to the words that are taken.

    New columns get underscores before their names where ``docs`` has them."""
    shard, place, taken, key = (tables.unused(n, docs) for n in ("shard", "place", "words", "key"))
    draws = mix(docs, params).draws.select(
        F.col("key").alias(key), F.col("words").alias(taken), F.col("shard").alias(shard), F.col("place").alias(place)
    )
    # Equal rows share a key and stand for each other.
    keyed = docs.withColumn(key, row_key(docs, params.seed)).dropDuplicates([key])
    full = keyed.join(draws, key).select(*docs.columns, taken, shard, place)
    text, at = docs.columns.index("text"), len(docs.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, most = batch.column(text).to_pylist(), batch.column(at).to_pylist()
            for i, (value, n) in enumerate(zip(texts, most)):
                raw = value.encode()
                found = words.find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                if n < len(found.ends):
                    texts[i] = raw[: found.ends[n - 1]].decode()
            yield batch.set_column(text, batch.schema.field(text), pa.array(texts, batch.column(text).type))

    return full.mapInArrow(cut, full.schema).repartition(shard).sortWithinPartitions(shard, place)


def words_taken(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``doc_id, size, source_size, target, taken, draws`` of every document: words and times it is taken."""
    found = mix(docs, params)
    sums = found.draws.groupBy("row").agg(F.sum("words").alias("taken"), F.count("*").alias("draws"))
    rows = found.placed.select("row", "doc_id", "size", "source_size", "target").join(sums, "row", "left")
    return rows.fillna(0, ["taken", "draws"]).drop("row")


def oracle_sql() -> str:
    """The same over ``documents``, with the default parameters, by running sums."""
    columns = ", ".join(
        f"coalesce(cast({c} AS varchar), chr(30))" for c in ("doc_id", "text", "lang", "source", "n_chars")
    )
    passes = [f"greatest(0, least(size, floor(target)::BIGINT - start - {k} * source_size))" for k in range(3)]
    return f"""
    WITH d AS (SELECT doc_id, source, md5(concat_ws(chr(31), '17', {columns})) AS key,
                      len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
    sources AS (SELECT source, source_size, rank, [5, 2, 1][1 + (rank - 1) % 3] AS weight
                FROM (SELECT source, cast(sum(size) AS bigint) AS source_size,
                             row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source)),
    levels AS (SELECT rank, full_words, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER w, 0))
                      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
               FROM (SELECT *, 3 * source_size / weight AS full_words FROM sources)
               WINDOW w AS (ORDER BY full_words, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    aims AS (SELECT *, least(3.0::DOUBLE * source_size, (SELECT level FROM levels WHERE full_words >= level ORDER BY full_words, rank LIMIT 1) * weight) AS target
             FROM sources),
    placed AS (SELECT d.doc_id, d.size, a.source_size, a.target,
                      coalesce(sum(d.size) OVER (PARTITION BY a.rank ORDER BY d.key
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
               FROM d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source)
    SELECT doc_id, size, source_size, target, cast({" + ".join(passes)} AS bigint) AS taken,
           cast({" + ".join(f"({p} > 0)::BIGINT" for p in passes)} AS bigint) AS draws
    FROM placed"""
