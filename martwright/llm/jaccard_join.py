"""N-gram Jaccard join by chosen paths.

Each distinct text is the set of its runs of five words, drawn as 128 minimum hashes; one of them is
a token that two sets share with a chance of their similarity. A run samples tokens: sets that agree
on a sampled token share a bucket, and a bucket that is still large is split again by tokens sampled
for it alone. Small buckets are compared by brute force, as are those no split makes small, in
blocks. A pair at the threshold survives a split as a critical branching process does, which says
how many runs reach the wanted recall.

Buckets yield a spanning forest of likely links rather than all pairs. Its components are then
verified exactly, all pairs of a component, in blocks; links are counted where they are found, so no
pair is ever written and none is counted twice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm import tables, words
from martwright.llm.components import components


@dataclass(frozen=True)
class JoinParams:
    """``margin`` is what an estimate from minimum hashes may fall short of the similarity."""

    words: int = 5
    similarity: float = 0.8
    recall: float = 0.99
    coordinates: int = 128
    depth: int = 3
    bucket: int = 128
    bucket_block: int = 1000
    block: int = 250
    margin: float = 0.13

    @property
    def runs(self) -> int:
        """Runs after which a pair at the threshold was together, at full depth, with ``recall``."""
        survival = 1.0
        for _ in range(self.depth):
            survival = 1 - math.exp(-survival)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - survival))

    @property
    def root(self) -> list[int]:
        """Tokens sampled at the root by all runs: 1 / similarity for each."""
        count = min(self.coordinates, math.ceil(self.runs / self.similarity))
        return sorted(np.random.default_rng(5).permutation(self.coordinates)[:count].tolist())


_RANDOM = np.random.default_rng(3).integers(0, 1 << 32, (2, 4096), dtype=np.uint64).astype(np.uint32)


def _texts(data: np.ndarray, places: np.ndarray, params: JoinParams) -> tuple[list, np.ndarray, np.ndarray]:
    """Key of each text (None without words), and its runs of words."""
    found = words.find_words(data, places)
    hashed = words.hash_words(data, found)[0]
    begin, end = found.first[:-1], found.first[1:]
    key = np.stack([words.stretches(h, begin, end) for h in (hashed, words.mix(hashed + np.uint64(97)))], axis=1)
    raw = np.ascontiguousarray(key.astype(">u8")).tobytes()
    keys = [raw[16 * i : 16 * i + 16] if a < b else None for i, (a, b) in enumerate(zip(begin, end))]
    return keys, *words.neighbours(hashed, found.first, params.words)


def sketches(docs: DataFrame, params: JoinParams) -> DataFrame:
    """``doc_id, key, sketch`` of every row; both NULL for a text without words."""
    narrow = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, shift = _RANDOM[0, : params.coordinates] | np.uint32(1), _RANDOM[1]
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for begin, end, data, places in words.blocks(batch):
                keys, runs, first = _texts(data, places, params)
                full = np.flatnonzero(np.diff(first))
                least = np.zeros((len(full), params.coordinates), np.uint32)
                values = (runs >> np.uint64(32)).astype(np.uint32)
                if len(full):
                    for k in range(params.coordinates):
                        mixed = values * factor[k] + shift[k]
                        mixed ^= mixed >> np.uint32(15)
                        least[:, k] = np.minimum.reduceat(mixed * np.uint32(0x2C1B3C6D), first[full])
                raw, size = least.tobytes(), 4 * params.coordinates
                sketch: list = [None] * (end - begin)
                for i, at in enumerate(full):
                    sketch[at] = raw[i * size : (i + 1) * size]
                columns = {"doc_id": ids.slice(begin, end - begin), "key": keys, "sketch": sketch}
                columns |= {c: pa.array(columns[c], pa.binary()) for c in ("key", "sketch")}
                yield pa.RecordBatch.from_pydict(columns)

    return tables.in_batches(narrow, run, tables.arrow_fields(narrow.select("doc_id"), "key binary, sketch binary"))


def _matrix(batch: pa.RecordBatch, params: JoinParams) -> np.ndarray:
    raw = b"".join(batch.column(batch.schema.get_field_index("sketch")).to_pylist())
    return np.frombuffer(raw, np.uint32).reshape(-1, params.coordinates)


def _split(rows: DataFrame, params: JoinParams, at_root: bool) -> DataFrame:
    """``path, key`` for the buckets that each row's set falls into next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.uint64(int((1 << 64) / (params.similarity * params.coordinates)) - 1)
        number = np.arange(1, params.coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            tokens = _matrix(batch, params)
            if at_root:
                chosen = np.zeros(tokens.shape, bool)
                chosen[:, params.root] = True
                path = np.zeros(len(tokens), np.uint64)
            else:
                at = batch.schema.get_field_index("path")
                path = batch.column(at).to_numpy(zero_copy_only=False).view(np.uint64)
                chosen = words.mix(path[:, None] ^ number) < limit
            row, k = np.nonzero(chosen)
            child = words.mix(words.mix(path[row] + number[k]) + tokens[row, k])
            keys = batch.column(batch.schema.get_field_index("key")).take(pa.array(row))
            yield pa.RecordBatch.from_pydict({"path": child.view(np.int64), "key": keys})

    return tables.in_batches(rows, run, "path long, key binary")


def in_groups(
    rows: DataFrame, group: list[str], judge: Callable[[pa.Table], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``judge`` on the rows of each group. Groups of a partition are read one after the other from
    one sorted stream, which spares the start of a call for each of very many small ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            changed = np.zeros(len(table), bool)
            for name in group:
                column = table.column(name).combine_chunks()
                if len(column) > 1:
                    changed[1:] |= np.asarray(pc.not_equal(column[1:], column[:-1]))
                if waiting and len(column):
                    changed[0] |= waiting[-1].column(name)[-1].as_py() != column[0].as_py()
            edges = [0, *np.flatnonzero(changed).tolist(), len(table)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                if k and waiting:
                    yield from _judged(waiting)
                    waiting = []
                if a < b:
                    waiting.append(table.slice(a, b - a))
        if waiting:
            yield from _judged(waiting)

    def _judged(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        out = judge(pa.concat_tables(parts))
        if out is not None:
            yield out

    return tables.in_batches(rows.repartition(*group).sortWithinPartitions(*group), run, schema)


def _forest(tokens: np.ndarray, least: float) -> np.ndarray:
    """For each set, the first set of its component when those that agree on a share of at least
    ``least`` of their tokens are linked."""
    label, rest = np.arange(len(tokens)), np.arange(len(tokens))
    while len(rest):
        first, waiting, rest = rest[0], [rest[0]], rest[1:]
        while waiting and len(rest):
            close = (tokens[rest] == tokens[waiting.pop()]).mean(axis=1) >= least
            label[rest[close]] = first
            waiting.extend(rest[close])
            rest = rest[~close]
    return label


def _likely(rows: DataFrame, group: list[str], params: JoinParams) -> DataFrame:
    """``a, b``: likely links within each bucket, as stars."""

    def judge(bucket: pa.Table) -> pa.RecordBatch | None:
        tokens = np.concatenate([_matrix(b, params) for b in bucket.to_batches()])
        label = _forest(tokens, params.similarity - params.margin)
        linked = np.flatnonzero(label != np.arange(len(label)))
        if not len(linked):
            return None
        keys = bucket.column("key").combine_chunks()
        return pa.RecordBatch.from_pydict({"a": keys.take(pa.array(linked)), "b": keys.take(pa.array(label[linked]))})

    return in_groups(rows, group, judge, "a binary, b binary")


def _block_pairs(rows: DataFrame, size: Column, block: int) -> DataFrame:
    """Rows of a group of ``size`` with ``own``, their block, once for every pair of blocks
    ``(one, two)`` that theirs is part of; a group of one block has one pair."""
    blocks = F.ceil(size / block).cast("int")
    dealt = rows.withColumn("_blocks", blocks).withColumn("own", F.pmod(F.xxhash64("key"), "_blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    paired = dealt.withColumn("_other", other)
    return paired.withColumns({"one": F.least("own", "_other"), "two": F.greatest("own", "_other")}).drop(
        "_blocks", "_other"
    )


def likely_links(sets: DataFrame, work: tables.Workspace, params: JoinParams) -> DataFrame:
    """``a, b``: keys of sets that some bucket holds together and whose sketches are close."""
    sets = sets.select("key", "sketch")
    rows, links = _split(sets, params, at_root=True), []
    for level in range(params.depth):
        sizes = rows.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
        members = work.store(rows.join(sizes, "path"))
        work.drop(rows)
        small = members.filter(F.col("size") <= params.bucket)
        # The same few sets meet in the buckets of most runs; they are compared once.
        same = small.groupBy("path").agg(F.sort_array(F.collect_list("key")).alias("keys"))
        once = same.groupBy("keys").agg(F.min("path").alias("path")).select("path", F.explode("keys").alias("key"))
        links.append(work.store(_likely(once.join(sets, "key"), ["path"], params)))
        large = members.filter(F.col("size") > params.bucket)
        if large.isEmpty():
            break
        if level + 1 == params.depth:
            blocks = _block_pairs(large, F.col("size"), params.bucket_block)
            links.append(work.store(_likely(blocks.join(sets, "key"), ["path", "one", "two"], params)))
        else:
            rows = work.store(_split(large.join(sets, "key"), params, at_root=False))
        work.drop(members)
    found = links[0]
    for part in links[1:]:
        found = found.unionByName(part)
    united = work.store(found.distinct())
    work.drop(*links)
    return united


def verified(
    docs: DataFrame, sets: DataFrame, groups: DataFrame, work: tables.Workspace, params: JoinParams
) -> DataFrame:
    """``key, label, links`` of sets with links: how many documents with other texts reach the
    similarity in one pair of blocks, and the least key linked with there."""
    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    known = groups.join(sizes, "root").join(sets.select(F.col("key").alias("node"), "copies"), "node")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [key for _, _, data, places in words.blocks(batch) for key in _texts(data, places, params)[0]]
            column = batch.column(batch.schema.get_field_index("text"))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), column], ["key", "text"])

    texts = tables.in_batches(docs.select("text"), keyed, "key binary, text string")
    texts = texts.join(known, F.col("key") == F.col("node"))
    once = texts.dropDuplicates(["key"]).select("root", "size", "key", "copies", "text")
    blocks = _block_pairs(once, F.col("size"), params.block)

    def judge(group: pa.Table) -> pa.RecordBatch | None:
        batch = group.combine_chunks().to_batches()[0]
        own, copies = (group.column(c).to_numpy() for c in ("own", "copies"))
        sets = []
        for _, _, data, places in words.blocks(batch):
            _, runs, first = _texts(data, places, params)
            sets += [np.unique(runs[a:b]) for a, b in zip(first, first[1:])]
        sizes = np.array([len(s) for s in sets])
        first = np.concatenate([[0], np.cumsum(sizes)])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        marked, links, label = np.zeros(flat.max() + 1, bool), np.zeros(len(sets), np.int64), np.arange(len(sets))
        across = group.column("one")[0].as_py() != group.column("two")[0].as_py()
        for i in range(len(sets) - 1):
            marked[flat[first[i] : first[i + 1]]] = True
            shared = np.add.reduceat(marked[flat[first[i + 1] :]], first[i + 1 : -1] - first[i + 1], dtype=np.int64)
            marked[flat[first[i] : first[i + 1]]] = False
            close = shared >= params.similarity * (sizes[i] + sizes[i + 1 :] - shared) - 1e-9
            if across:
                close &= own[i + 1 :] != own[i]
            for j in np.flatnonzero(close) + i + 1:
                links[i] += copies[j]
                links[j] += copies[i]
                label[label == max(label[i], label[j])] = min(label[i], label[j])
        linked = np.flatnonzero(links)
        if not len(linked):
            return None
        keys = batch.column(batch.schema.get_field_index("key"))
        return pa.RecordBatch.from_pydict(
            {
                "key": keys.take(pa.array(linked)),
                "label": keys.take(pa.array(label[linked])),
                "links": links[linked],
            }
        )

    return work.store(in_groups(blocks, ["root", "one", "two"], judge, "key binary, label binary, links long"))


_RANK = "coalesce(cast(doc_id as long), 9223372036854775807L)"


def classes(docs: DataFrame, work: tables.Workspace, params: JoinParams = JoinParams()) -> tuple[DataFrame, DataFrame]:
    """``(rows, sets)``: ``doc_id, key`` of every row, and of every text ``key, copies, rank, links,
    class_key, class_rank``. Ranks are ids, NULL last; a class is a component of links, and
    ``class_rank, class_key`` are those of the first document in it.
    """
    sketched = work.store(sketches(docs, params))
    rows = work.store(sketched.select("doc_id", "key"))
    sets = work.store(
        sketched.filter("key is not null")
        .groupBy("key")
        .agg(F.count("*").alias("copies"), F.min(F.expr(_RANK)).alias("rank"), F.first("sketch").alias("sketch"))
    )
    work.drop(sketched)
    likely = likely_links(sets, work, params)
    narrow = work.store(sets.drop("sketch"))
    work.drop(sets)
    groups = components(work, likely)
    work.drop(likely)
    found = verified(docs, narrow, groups, work, params)
    work.drop(groups)
    linked = components(work, found.select(F.col("key").alias("a"), F.col("label").alias("b")))
    totals = found.groupBy("key").agg(F.sum("links").alias("links"))
    joined = narrow.join(totals, "key", "left").join(linked, F.col("key") == F.col("node"), "left").drop("node")
    joined = work.store(joined.withColumn("root", F.coalesce("root", "key")))
    first = joined.groupBy("root").agg(F.min(F.struct("rank", "key")).alias("first"))
    named = joined.join(first, "root").select(
        *["key", "copies", "rank"],
        F.coalesce("links", F.lit(0)).alias("links"),
        F.col("first.key").alias("class_key"),
        F.col("first.rank").alias("class_rank"),
    )
    named = work.store(named)
    work.drop(narrow, found, linked, joined)
    return rows, named


def jaccard_join(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """``doc_id, class_id, n_links`` of every row.

    Texts are equal if their words, runs of anything but white space of ASCII, are; ``class_id`` is
    the least id among the documents that links join, directly or through others, and ``n_links``
    the number of other rows with a similarity of at least ``params.similarity``, copies included. A
    text of fewer than five words is one run; one without words, or NULL, has no links and is its
    own class. Repeated rows are copies. NULL ids rank last; a class without an id has none.
    """
    rows, sets = classes(docs, tables.Workspace(docs.sparkSession), params)
    named = sets.select(
        "key",
        F.when(F.col("class_rank") != (1 << 63) - 1, F.col("class_rank")).alias("class_id"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"),
    )
    own = F.when(F.col("key").isNull(), F.col("doc_id").cast("long")).otherwise(F.col("class_id"))
    return rows.join(named, "key", "left").select(
        "doc_id", own.alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    )


def first_of_each(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """Rows of ``docs`` with the first document of each class, and those without words.

    Of rows that repeat an id and its words one stays.
    """
    key, rank, schema = tables.unused("key", docs), tables.unused("rank", docs), docs.schema

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k for _, _, data, places in words.blocks(batch) for k in _texts(data, places, params)[0]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, key])

    work = tables.Workspace(docs.sparkSession)
    rows, sets = classes(docs.select("doc_id", "text"), work, params)
    first = sets.filter("key = class_key").select(F.col("key").alias(key), F.col("rank").alias(rank))
    chosen = work.store(first)
    work.drop(rows, sets)
    with_key = tables.in_batches(docs, keyed, tables.arrow_fields(docs, f"`{key}` binary"))
    with_key = with_key.withColumn(rank, F.expr(_RANK))
    kept = with_key.join(chosen, [key, rank]).dropDuplicates([key, rank])
    return kept.select(*schema.names).unionByName(with_key.filter(F.col(key).isNull()).select(*schema.names))
