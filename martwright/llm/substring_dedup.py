"""Substring dedup: units of lines are hashed, and repeated stretches of them removed.

A line is cut into units at ends of sentences and after anchor words, those with the smallest hash of
any ``anchors`` neighbouring words of a sentence; so a passage falls into equal units wherever it
stands in a line, but for its first and last words, and no unit is longer than that. Units are normalised to
their letters and digits in lower case and grouped by a 96-bit digest over all documents. The
occurrence that ranks first, by document id and place, stays. Runs of neighbouring repeats with
enough words are removed; shorter ones, such as common phrases, are left alone, unless they are whole
lines, which are grouped by a digest of their own.

One shuffle finds the first occurrences. Of each digest, only the first places within some ``GROUP_BYTES`` of
text go where the digest is grouped; the others of those texts are repeats whatever comes of it, and are
spread over all tasks. So a line that stands in a third of all documents is no bottleneck.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm import tables, words


@dataclass(frozen=True)
class DedupParams:
    """A run of repeats is removed from ``least_words`` on; of any ``anchors`` neighbouring words of a
    sentence one at least ends a unit. A line that repeats a whole line is removed from
    ``least_line_words`` on; 0 leaves lines to the rule for runs."""

    least_words: int = 20
    anchors: int = 8
    least_line_words: int = 0


#: Bytes that end a sentence or a line.
ENDS = b".!?\n"
_ENDS = np.isin(np.arange(256), np.frombuffer(ENDS, np.uint8))
#: Ranks from here on belong to documents without an id, which come after all others, by a hash of the text.
#: With the print that makes 63 bits by which such documents are told apart.
_LAST = (1 << 63) - (1 << 31)
_RANK = f"coalesce(cast(doc_id AS bigint), {_LAST} + (xxhash64(text) & {(1 << 31) - 1}))"

#: Bytes of text of which a few places per digest are compared with those of other texts.
GROUP_BYTES = 8 * 1024**2
#: How many, if the first place is reported; else one is enough.
PLACES = 16

#: ``high``, ``more``: a digest, of which ``more`` has the lower 32 bits; for a place that is known to be a repeat,
#: ``more`` has a hash above them and is negative. ``info``: words in the lower 24 bits; above, for a line, one more
#: than the number of its last unit.
UNITS = "high long, more long, rank long, place long, info long, begin int, end int"
_WORDS, _LINE, _LOW = 0xFFFFFF, 24, 0xFFFFFFFF
_LINES = 1 << 40


def cut_units(data: np.ndarray, places: np.ndarray, params: DedupParams) -> tuple[words.Words, np.ndarray, np.ndarray]:
    """Words, their hashes, and the first word of each unit and, at the end, the number of words."""
    found = words.find_words(data, places, words.ALNUM)
    hashed = words.hash_words(data, found, lower=True)[0]
    if not len(hashed):
        return found, hashed, np.zeros(1, np.int64)
    ends = np.concatenate([[0], np.cumsum(_ENDS[data])])
    opens = np.ones(len(hashed), bool)
    opens[1:] = ends[found.starts[1:]] > ends[found.ends[:-1]]
    opens[found.first[:-1][np.diff(found.first) > 0]] = True
    opens[1:] |= anchor_words(hashed, np.cumsum(opens), params.anchors)[:-1]
    return found, hashed, np.append(np.flatnonzero(opens), len(hashed))


def anchor_words(hashed: np.ndarray, sentence: np.ndarray, width: int) -> np.ndarray:
    """Whether a word has the smallest hash, the last of equal ones, of ``width`` neighbours in its sentence."""
    out, count = np.zeros(len(hashed), bool), len(hashed) - width + 1
    if count > 0:
        mixed = words.mix(hashed + np.uint64(53))
        least, at = mixed[:count].copy(), np.zeros(count, np.int64)
        for n in range(1, width):
            lower = mixed[n : n + count] <= least
            least[lower], at[lower] = mixed[n : n + count][lower], n
        begin = np.flatnonzero(sentence[:count] == sentence[width - 1 :])
        out[begin + at[begin]] = True
    return out


def prints(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of each whole text in the upper half of 64 bits."""
    whole = words.Words(places[:-1], places[1:], np.arange(len(places)))
    return words.hash_words(data, whole)[0].view(np.int64) & ~np.int64(0xFFFFFFFF)


def units(docs: DataFrame, params: DedupParams, spans: bool = True) -> DataFrame:
    """One row per unit of every text, with its place in characters.

    ``rank`` is the id, or a number above all ids for NULL. ``place`` has half of a hash of the whole
    text above the number of the unit, so that two texts under one id are two documents, and a
    repeated row is the same one. Without ``spans`` places known to be repeats have no digest.
    """

    def columns(ids: np.ndarray, data: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
        found, hashed, cuts = cut_units(data, places, params)
        if not len(hashed):
            return [np.zeros(0, np.int64)] * 7
        text = found.text[cuts[:-1]]
        first = np.searchsorted(text, np.arange(len(places)))
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        unit = np.arange(len(text)) - first[text]
        printed = prints(data, places)

        def rows(hashed: np.ndarray, a: np.ndarray, b: np.ndarray, lines: bool) -> list[np.ndarray]:
            """Of the stretches from the first word of unit a to the last one before unit b."""
            begin, end, of = cuts[a], cuts[b], text[a]
            return [
                words.stretches(hashed, begin, end).view(np.int64),
                (words.stretches(words.mix(hashed + np.uint64(97)), begin, end) & np.uint64(_LOW)).view(np.int64),
                ids[of],
                printed[of] | unit[a],
                np.minimum(end - begin, _WORDS) | ((unit[b - 1] + 1) << _LINE if lines else 0),
                chars[found.starts[begin]] - chars[places[of]],
                chars[found.ends[end - 1]] - chars[places[of]],
            ]

        out = rows(hashed, np.arange(len(text)), np.arange(1, len(cuts)), False)
        if params.least_line_words:
            breaks = np.concatenate([[0], np.cumsum(data == 10)])
            opens = breaks[found.starts[cuts[1:-1]]] > breaks[found.ends[cuts[1:-1] - 1]]
            opens |= text[1:] != text[:-1]
            a = np.flatnonzero(np.append(True, opens))
            b = np.append(a[1:], len(text))
            # Those with as many words as a run needs are removed as runs.
            sizes = cuts[b] - cuts[a]
            some = (sizes >= params.least_line_words) & (sizes < params.least_words)
            lines = rows(words.mix(hashed + np.uint64(31)), a[some], b[some], True)
            out = [np.concatenate(both) for both in zip(out, lines)]
        return out

    def batch_of(waiting: list[list[np.ndarray]]) -> pa.RecordBatch:
        """Rows of some texts, each place once; marked, where enough places of its digest come before it."""
        columns = [np.concatenate(c) for c in zip(*waiting)]
        order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
        columns = [c[order] for c in columns]
        new = [np.append(True, c[1:] != c[:-1]) for c in columns[:4]]
        once = np.logical_or.reduce(new)
        opens = (new[0] | new[1])[once]
        high, low, rank, place, *rest = (c[once] for c in columns)
        number = np.arange(len(opens))
        number -= np.maximum.accumulate(np.where(opens, number, 0))
        known = number >= (PLACES if spans else 1)
        spread = words.mix(place.view(np.uint64) ^ words.mix(rank.view(np.uint64))) | np.uint64(1 << 63)
        marked = (spread & ~np.uint64(_LOW)).view(np.int64) | (low if spans else 0)
        columns = [high if spans else np.where(known, 0, high), np.where(known, marked, low), rank, place, *rest]
        columns = [pa.array(c).cast(f.type) for c, f in zip(columns, _ARROW_UNITS)]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW_UNITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            for row, end, data, places in words.blocks(batch):
                cut = columns(ids[row:end], data, places)
                waiting += [cut] if len(cut[0]) else []
                size += len(data)
                if waiting and size >= GROUP_BYTES:
                    yield batch_of(waiting)
                    waiting, size = [], 0
        if waiting:
            yield batch_of(waiting)

    ranked = docs.select(F.expr(_RANK).alias("rank"), "text")
    return tables.in_batches(ranked, run, UNITS)


_ARROW_UNITS = pa.schema(
    [(name, pa.int32() if kind == "int" else pa.int64()) for name, kind in (c.split() for c in UNITS.split(", "))]
)


def repeats(docs: DataFrame, params: DedupParams, spans: bool) -> DataFrame:
    """``rank, print, first_unit, last_unit, words`` of each stretch to remove.

    With ``spans`` also its characters ``begin, end``, and ``kept_rank, kept_begin``, where the first
    occurrence of its first unit stands. The group of a digest has at most ``PLACES`` places per
    ``GROUP_BYTES`` of text, or one without ``spans``.
    """
    by_digest = Window.partitionBy("high", "more").orderBy("rank", "place")
    by_digest = by_digest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    more = ["begin"] if spans else []
    firsts = [F.first(c).over(by_digest).alias(f"first_{c}") for c in ["rank", "place", *more]]
    all_units = units(docs, params, spans).select("*", *firsts)
    known, is_first = F.col("more") < 0, F.expr("rank = first_rank and place = first_place")
    later = all_units.filter(known | ~is_first)
    print_, unit = F.shiftright("place", 32).alias("print"), F.col("place").bitwiseAND(F.lit(_LOW))
    # Lines come after all units.
    at = F.when(F.shiftright("info", _LINE) > 0, unit + F.lit(_LINES)).otherwise(unit).alias("at")
    kept = []
    if spans:
        # Of a place that is known to be a repeat the first one isn't; the digest leads to it.
        a = F.when(known, F.col("high")).otherwise(F.col("first_rank")).alias("a")
        b = F.when(known, F.col("more").bitwiseAND(F.lit(_LOW))).otherwise(-1 - F.col("first_begin")).alias("b")
        kept = ["begin", "end", a, b]
    # One shuffle by document serves all that follows. Repeated rows give a unit more than once.
    by_unit = Window.partitionBy("rank", "print").orderBy("at")
    found = later.select("rank", print_, at, "info", *kept).withColumn("before", F.lag("at").over(by_unit))
    found = found.filter("before is null or before <> at")
    line, unit = F.col("at") >= _LINES, F.col("at") % F.lit(_LINES)
    # Neighbouring units differ from their number among the repeats of a document by the same amount,
    # -1 or more; each line is by itself.
    found = found.withColumn("run", F.when(line, -2 - unit).otherwise(unit - F.row_number().over(by_unit)))
    found = found.withColumn("line", line).withColumn("unit", unit)
    found = found.withColumn("words", F.col("info").bitwiseAND(F.lit(_WORDS)).cast("int"))
    found = found.withColumn("last", F.when(line, F.shiftright("info", _LINE) - 1).otherwise(unit))
    runs = found.groupBy("rank", "print", "run")
    last = F.max("last").alias("last_unit")
    measures = [F.min("unit").alias("first_unit"), last, F.sum("words").alias("words"), F.max("line").alias("line")]
    if spans:
        measures += [F.min("begin").alias("begin"), F.max("end").alias("end"), F.min_by(F.struct("a", "b"), "unit").alias("kept")]
    out = runs.agg(*measures).filter(F.col("line") | (F.col("words") >= params.least_words)).drop("run")
    if params.least_line_words:  # the units of a repeated line are repeats, so a run has all of them or none
        earlier = Window.partitionBy("rank", "print").orderBy("first_unit", F.desc("last_unit"))
        covered = F.max("last_unit").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
        out = out.withColumn("covered", covered).filter("covered is null or covered < last_unit").drop("covered")
    return _with_first(out.drop("line"), docs, params) if spans else out.drop("line")


def _with_first(runs: DataFrame, docs: DataFrame, params: DedupParams) -> DataFrame:
    """``kept_rank, kept_begin`` of runs. Those that have a digest, which stood often in some texts, get the first
    place of that, from cutting the texts again; only such digests are grouped."""
    work = tables.Workspace(docs.sparkSession)
    runs, opened = work.store(runs), F.col("kept.b") >= 0
    wanted = work.store(runs.filter(opened).select(F.expr("kept.a AS high"), F.expr("kept.b AS more")).distinct())
    first = F.min(F.struct("rank", "place", "begin")).alias("first")
    firsts = work.store(units(docs, params).join(wanted, ["high", "more"]).groupBy("high", "more").agg(first))
    same = (F.col("kept.a") == F.col("high")) & (F.col("kept.b") == F.col("more"))
    found = runs.filter(opened).join(firsts, same).select(*runs.columns, F.expr("first.rank AS a"), F.expr("first.begin AS b"))
    known = runs.filter(~opened).select("*", F.expr("kept.a AS a"), F.expr("int(-1 - kept.b) AS b"))
    return known.unionByName(found).drop("kept").withColumnsRenamed({"a": "kept_rank", "b": "kept_begin"})


def removed_spans(docs: DataFrame, params: DedupParams = DedupParams()) -> DataFrame:
    """``doc_id, begin, end, n_words, n_units, kept_doc_id, kept_begin`` of each removed stretch.

    Places are characters of the original text. Rows that repeat an id and its text are one
    document, and reported once; NULL ids rank last, those with the same text as one document. NULL
    and empty texts and texts without a letter or digit have no units.
    """
    known = lambda c: F.when(F.col(c) < _LAST, F.col(c))
    return repeats(docs, params, spans=True).select(
        known("rank").alias("doc_id"),
        F.col("begin").cast("long").alias("begin"),
        F.col("end").cast("long").alias("end"),
        F.col("words").alias("n_words"),
        (F.col("last_unit") - F.col("first_unit") + 1).alias("n_units"),
        known("kept_rank").alias("kept_doc_id"),
        F.col("kept_begin").cast("long").alias("kept_begin"),
    )


def remove_repeats(docs: DataFrame, params: DedupParams = DedupParams()) -> DataFrame:
    """``docs`` with the repeated stretches cut from ``text``, all rows and columns kept.

    What stood between a stretch and the words around it stays, such as line breaks.
    """
    columns, schema = docs.columns, docs.schema
    rank, print_, spans = (tables.unused(n, docs) for n in ("rank", "print", "spans"))

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.zeros(0, np.int64)] + [prints(data, places) >> 32 for _, _, data, places in words.blocks(batch)]
            column = pa.array(np.concatenate(hashes))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, print_])

    cuts = (
        repeats(docs.select("doc_id", "text"), params, spans=False)
        .groupBy(F.col("rank").alias(rank), F.col("print").alias(print_))
        .agg(F.sort_array(F.collect_list(F.struct("first_unit", "last_unit"))).alias(spans))
    )
    keyed = tables.in_batches(docs, printed, tables.arrow_fields(docs, f"`{print_}` long"))
    keyed = keyed.withColumn(rank, F.expr(_RANK))
    joined = keyed.join(cuts, [rank, print_], "left").select(*columns, spans)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, places = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for i, stretches in enumerate(places):
                if stretches:
                    texts[i] = _without(texts[i].encode(), [s.values() for s in stretches], params)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.column(at).type)).select(columns)

    return tables.in_batches(joined, cut, schema)


def _without(text: bytes, stretches: list, params: DedupParams) -> str:
    """The text without runs of units, given by the first and the last of each, in order. Runs of another text
    with the same id and print, which can lie beyond the end, are passed over."""
    data = np.frombuffer(text, np.uint8)
    found, _, cuts = cut_units(data, np.array([0, len(data)]), params)
    kept, at = [], 0
    for first, last in stretches:
        if last + 1 >= len(cuts):
            continue
        kept.append(text[at : found.starts[cuts[first]]])
        at = found.ends[cuts[last + 1] - 1]
    return b"".join([*kept, text[at:]]).decode()
