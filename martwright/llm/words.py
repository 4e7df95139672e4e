"""Words of texts as arrays: their places and 64-bit hashes, for whole Arrow columns at once.

A batch is walked in blocks of a few megabytes, so memory follows the block, and the longest text,
rather than the batch. Hashes are those of a polynomial over a word's bytes: with running sums, any
stretch of bytes has its hash by one subtraction and one product modulo 2^64.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1024**2
#: Bytes hashed at a time.
SPAN = 1 << 18

#: White space of ASCII, which separates plain words.
SPACES = b" \t\n\x0b\x0c\r"

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))
#: Bytes of plain words: all but white space.
PLAIN = ~_SPACE
#: Bytes of letters and digits; those above 127 belong to letters beyond ASCII.
ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_EXACT = (np.arange(256) + 1).astype(np.uint64)
_LOWER = np.array([(b + 32 if 65 <= b <= 90 else b) + 1 for b in range(256)], np.uint64)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column without NULLs, which become ''."""
    values = batch.column(batch.schema.get_field_index(name))
    values = values.cast(pa.large_string())
    return values.fill_null("") if values.null_count else values


def buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 places where they begin and end."""
    raw = values.buffers()
    if len(values) == 0 or raw[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    places = np.frombuffer(raw[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(raw[2], np.uint8)[places[0] : places[-1]]
    return data, places - places[0]


def blocks(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, places)`` of runs of rows with some ``BLOCK_BYTES`` of text."""
    _free()
    data, places = buffers(column(batch, name))
    row, rows = 0, len(places) - 1
    while row < rows:
        end = int(np.searchsorted(places, places[row] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[places[row] : places[end]], places[row : end + 1] - places[row]
        row = end


def _free() -> None:
    """Free what earlier tasks of this worker left in cycles: functions that were shipped refer to
    themselves, and with them to arrays. Objects of the libraries are set aside once, so that
    looking through the rest takes little."""
    gc.collect()
    if not gc.get_freeze_count():
        gc.freeze()
    pa.default_memory_pool().release_unused()


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function of a task, which gives memory back to the system when the task ends: a worker that
    waits for the next task, perhaps of another operator, holds no arrays of this one."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _free()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


@dataclass
class Words:
    """Words of some texts: where they begin and end, and ``first[i]``, the first word of text i."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """The text each word is of."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(data: np.ndarray, places: np.ndarray, inside: np.ndarray = PLAIN) -> Words:
    """Maximal runs of bytes for which ``inside`` holds, none across two texts."""
    member = inside[data]
    edges = places[:-1][places[:-1] < places[1:]]
    opening, closing = member.copy(), member.copy()
    opening[1:] &= ~member[:-1]
    opening[edges] = member[edges]
    closing[:-1] &= ~member[1:]
    closing[edges[1:] - 1] = member[edges[1:] - 1]
    starts = np.flatnonzero(opening)
    return Words(starts, np.flatnonzero(closing) + 1, np.searchsorted(starts, places))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_powers.get("up", ())) < n:
        n = max(n, SPAN)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            ladder = np.full(n, base, np.uint64)
            ladder[0] = 1
            _powers[name] = np.multiply.accumulate(ladder)
    return _powers["up"], _powers["down"]


def hash_words(
    data: np.ndarray, words: Words, lower: bool = False, prefixes: tuple[int, ...] = ()
) -> list[np.ndarray]:
    """Hash of each word, then, for each length of ``prefixes``, of its first bytes (0: shorter)."""
    starts, ends = words.starts, words.ends
    value = _LOWER if lower else _EXACT
    out = [np.zeros(len(starts), np.uint64) for _ in range(1 + len(prefixes))]
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + SPAN, "right"))
        if j == i:  # one very long word
            whole = data[starts[i] : ends[i]].tobytes()
            out[0][i] = xxhash.xxh64_intdigest(whole.lower() if lower else whole)
            for k, n in enumerate(prefixes):
                out[1 + k][i] = xxhash.xxh64_intdigest(whole[:n])
            i += 1
            continue
        low, high = starts[i], ends[j - 1]
        up, down = powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(value[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        begun, scale = sums[s], down[s]
        out[0][i:j] = mix((sums[e] - begun) * scale)
        for k, n in enumerate(prefixes):
            long = e - s > n
            out[1 + k][i:j][long] = mix((sums[s[long] + n] - begun[long]) * scale[long] + np.uint64(n))
        i = j
    return out


def neighbours(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of n words within a text and, per text, the first of its runs.

    A text with fewer words, but at least one, has one run of all its words.
    """
    sizes = np.diff(first)
    runs = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    begins = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(first[:-1] - begins[:-1], runs) + np.arange(begins[-1])
    return stretches(hashes, at, np.minimum(at + n, np.repeat(first[1:], runs))), begins


def stretches(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each sequence ``hashes[begin:end]``."""
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for each i; of nothing, 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
