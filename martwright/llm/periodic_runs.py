"""Periodic runs: stretches of words that repeat with a period, found by dyadic square catching.

At level k the words of a text fall into blocks of 2^k. A completed block catches the squares whose
period is at least twice and less than four times its length: the first half of any such square, and
of a run with that period, holds a whole block, which comes back one period later. So each appended
word is asked, per level, whether the 2^k words from it on equal one of two blocks, those two and three
blocks back. A hit is extended by comparing suffixes and prefixes one period apart; if what agrees is as
long as the period, it is a square, and its longest extension a run, into which the squares of
neighbouring blocks merge. Hits inside a known run whose period divides theirs add nothing and are passed
over. Periods below 4 are compared directly.

The words of many texts are appended level by level rather than word by word, in arrays: the same
comparisons in another order, some 2 log n per word. A word of its own parts neighbouring texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import tables, words


@dataclass(frozen=True)
class RunParams:
    """A run has at least ``least_words`` words, and two periods."""

    least_words: int = 12


#: Periods up to this are compared directly.
_SHORT = 3
#: Two primes below 2^31 and a base for each.
_FIELDS = ((2147483647, 1103515245), (2147483629, 69069069))

RUNS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Comparer:
    """Equality of stretches of a sequence by two sums modulo primes, whatever their length."""

    def __init__(self, sequence: np.ndarray):
        self.size, self.tables = len(sequence), []
        mixed = words.mix(sequence.view(np.uint64) + np.uint64(11))
        for prime, base in _FIELDS:
            powers = np.ones(self.size + 1, np.int64)
            done = 1
            while done <= self.size:
                step = pow(base, done, prime)
                more = min(done, self.size + 1 - done)
                powers[done : done + more] = powers[:more] * step % prime
                done += more
            sums = np.zeros(self.size + 1, np.int64)
            np.cumsum((mixed % np.uint64(prime)).astype(np.int64) * powers[:-1] % prime, out=sums[1:])
            self.tables.append((prime, powers, sums % prime))

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``size`` from a and from b on agree; a is before b."""
        same = (a >= 0) & (b + size <= self.size)
        a, b, size = np.where(same, a, 0), np.where(same, b, 0), np.where(same, size, 0)
        for prime, powers, sums in self.tables:
            left = (sums[a + size] - sums[a]) % prime * powers[b - a] % prime
            same &= left == (sums[b + size] - sums[b]) % prime
        return same

    def extend(self, at: np.ndarray, period: np.ndarray, limit: int, back: bool) -> np.ndarray:
        """How many words from ``at`` on, or before it, equal those one period later."""
        found = np.zeros(len(at), np.int64)
        step = 1 << max(limit, 1).bit_length()
        while step:
            begin = at - found - step if back else at + found
            found += np.where(self.equal(begin, begin + period, np.full(len(at), step)), step, 0)
            step >>= 1
        return found


def agreeing(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each stretch of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


class Caught:
    """Runs found so far, and for each word the one around it that reaches furthest."""

    def __init__(self, size: int):
        self.found: list[tuple[int, int, int]] = []
        self.reach, self.period = np.zeros(size, np.int64), np.ones(size, np.int64)

    def add(self, begin: int, end: int, period: int) -> None:
        self.found.append((begin, end, period))
        nearer = self.reach[begin:end] < end
        self.reach[begin:end][nearer] = end
        self.period[begin:end][nearer] = period


def find_runs(ids: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, length, period)`` of all runs, ordered; text i has the words ``ids[first[i]:first[i + 1]]``."""
    sizes = np.diff(first)
    gaps = first[1:] + np.arange(len(sizes))
    sequence = np.empty(len(ids) + len(sizes), np.int64)
    inside = np.ones(len(sequence), bool)
    inside[gaps] = False
    sequence[inside], sequence[gaps] = ids, -1 - np.arange(len(sizes))
    longest = int(sizes.max(initial=0))

    caught = Caught(len(sequence))
    for period in range(1, min(_SHORT, longest // 2) + 1):
        begin, end = agreeing(sequence[period:] == sequence[:-period])
        long = end - begin >= max(period, least - period)
        for a, b in zip(begin[long].tolist(), end[long].tolist()):
            caught.add(a, b + period, period)
    _catch_squares(sequence, longest, least, caught)

    found = np.array(sorted(caught.found), np.int64).reshape(-1, 3)
    smallest = np.ones(len(found), bool)  # of periods with the same words, the smallest comes first
    smallest[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    begin, end, period = found[smallest].T
    text = np.searchsorted(gaps, begin)
    start = begin - (first[text] + text)
    order = np.lexsort((period, start, text))
    return text[order], start[order], (end - begin)[order], period[order]


def _catch_squares(sequence: np.ndarray, longest: int, least: int, caught: Caught) -> None:
    """Runs of periods beyond the short ones, level by level."""
    comparer, size = None, 2
    hashed = words.mix(sequence.view(np.uint64) + np.uint64(29))
    hashed = words.mix(hashed[:-1] * np.uint64(words._BASE) + hashed[1:])
    while 2 * size <= longest // 2:  # hashed: of the ``size`` words from each on
        at, later = _hits(hashed, size)
        period = later - at
        known = (later + size <= caught.reach[at]) & (period % caught.period[at] == 0)
        at, period = at[~known], period[~known]
        if len(at):
            comparer = comparer or Comparer(sequence)
            for begin, end, p in _extended(sequence, comparer, at, period, size, longest, least):
                caught.add(begin, end, p)
        hashed = words.mix(hashed[:-size] * np.uint64(words._BASE) + hashed[size:])
        size *= 2


def _hits(hashed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks, and where the words of one come back two to four times its length later."""
    count = -(-len(hashed) // size)
    rows = np.zeros(count * size, np.uint64)
    rows[: len(hashed)] = hashed
    rows = rows.reshape(count, size)
    at, later = [], []
    for back in (2, 3):
        row, offset = np.nonzero(rows[back:] == rows[:-back, :1])
        at.append(row * size)
        later.append((row + back) * size + offset)
    at, later = np.concatenate(at), np.concatenate(later)
    real = later < len(hashed)
    return at[real], later[real]


def _extended(
    sequence: np.ndarray, comparer: Comparer, at: np.ndarray, period: np.ndarray, size: int, longest: int, least: int
) -> list[tuple[int, int, int]]:
    """Runs around hits: neighbouring blocks with the same period are extended as one."""
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    opens = np.ones(len(at), bool)
    opens[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + size)
    low, period = at[opens], period[opens]
    high = at[np.append(np.flatnonzero(opens)[1:], len(at)) - 1] + size
    needed = np.maximum(period, least - period)
    # Of what a block lacks, at least half is on one side.
    half = np.maximum((needed - (high - low) + 1) // 2, 0)
    likely = comparer.equal(high, high + period, half) | comparer.equal(low - half, low - half + period, half)
    low, high, period, needed = low[likely], high[likely], period[likely], needed[likely]
    begin = low - comparer.extend(low, period, longest, back=True)
    end = high + comparer.extend(high, period, longest, back=False)
    square = end - begin >= needed
    out = []
    for a, b, p, least_words in zip(*(x[square].tolist() for x in (begin, end, period, needed))):
        # Hashes only propose: the words themselves decide.
        for c, d in zip(*agreeing(sequence[a:b] == sequence[a + p : b + p])):
            if d - c >= least_words:
                out.append((a + int(c), a + int(d) + p, p))
    return sorted(set(out), key=lambda run: run[2])


def word_array(data: np.ndarray, found: words.Words) -> pa.LargeStringArray:
    """The words themselves, in a column."""
    offsets = np.concatenate([[0], np.cumsum(found.ends - found.starts)]).astype(np.int64)
    letters = np.ascontiguousarray(data[words.PLAIN[data]])
    return pa.LargeStringArray.from_buffers(len(found.starts), pa.py_buffer(offsets), pa.py_buffer(letters))


def joined(column: pa.LargeStringArray, first: np.ndarray) -> pa.Array:
    """Words of each text, with one space between."""
    lists = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), column)
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def periodic_runs(docs: DataFrame, params: RunParams = RunParams()) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    Words are parted by ASCII white space and numbered from 0. ``runs`` holds ``(start, length, period)`` of
    every run, ordered by start and period: the longest stretches of at least ``least_words`` words and two
    smallest periods, in which words one period apart are equal. ``collapsed`` has the words, parted by one
    space, without those that a run holds after its first period. A NULL or empty text has no words, no
    runs and a collapsed text of ''. Repeated rows are rows of their own; other columns are left alone; an
    empty table gives none. A text is judged as a whole, in memory of some 100 bytes a word.
    """
    narrow = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, places in words.blocks(batch):
                found = words.find_words(data, places)
                column = word_array(data, found)
                ids = column.dictionary_encode().indices.to_numpy().astype(np.int64)
                text, start, length, period = find_runs(ids, found.first, params.least_words)
                # A word goes where more runs have passed their first period than have ended.
                open_ = np.bincount(found.first[text] + start + period, minlength=len(ids) + 1)
                close = np.bincount(found.first[text] + start + length, minlength=len(ids) + 1)
                kept = np.cumsum(open_ - close)[: len(ids)] == 0
                left = np.concatenate([[0], np.cumsum(kept)])[found.first]
                offsets = np.searchsorted(text, np.arange(end - row + 1)).astype(np.int32)
                names = ["start", "length", "period"]
                triples = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], names)
                collapsed = joined(column.filter(pa.array(kept)), left)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row),
                        pa.array(np.diff(found.first), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), triples),
                        collapsed.cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return narrow.mapInArrow(run, tables.arrow_fields(narrow.select("doc_id"), RUNS))


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with known periods put in: where the crc32 of the id is divisible by 10, the words
    from ``a`` on become the first ``p`` of them, over and over. Rows without an id stay as they are."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, places in words.blocks(batch):
                part = batch.slice(row, end - row)
                chosen = [i for i, h in enumerate(part.column(2).to_pylist()) if h is not None and h % 10 == 0]
                texts = words.column(part, "text").cast(pa.string())
                if chosen:
                    found = words.find_words(data, places)
                    source = np.arange(len(found.starts))
                    for i in chosen:
                        begin, n = int(found.first[i]), int(found.first[i + 1] - found.first[i])
                        if n:
                            g = part.column(2)[i].as_py() // 10
                            a = g % n
                            p = 1 + (n - a) // (3 + g % 8)
                            source[begin + a : begin + n] = begin + a + np.arange(n - a) % p
                    column = word_array(data, found).take(pa.array(source))
                    planted = joined(column, found.first).cast(pa.string())
                    mask = np.zeros(len(part), bool)
                    mask[chosen] = True
                    texts = pc.if_else(pa.array(mask), planted, texts)
                yield pa.RecordBatch.from_arrays([part.column(0), texts], ["doc_id", "text"])

    narrow = docs.select("doc_id", "text", hashed)
    return narrow.mapInArrow(run, tables.arrow_fields(narrow.select("doc_id"), "text string"))


def digests(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs`` its number of runs, the longest, and hashes of all runs and of what is left.

    Of equally long runs the one that starts first, then the one with the smaller period is named."""
    ranked = lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))
    best = F.array_max(F.transform("runs", ranked))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
