"""Benchmark decontamination by latent semantic retrieval.

Passages are the lines of all documents, weighted by TF-IDF. A randomised singular value
decomposition, whose products with the matrix of passages are sums over Spark tasks, gives a latent
space for the terms of the benchmark, completed by what the items have outside it. A stretch of a
document is a candidate if its product with an item there is at least what the decision needs; the
longest common subsequence of words, and whether the item's answer, its last sentence, is there too,
decide. As the space holds the items whole and words add up, no stretch that the decision would
accept stays unchecked, whatever words were put in, left out or replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import tables, words


@dataclass(frozen=True)
class LeakParams:
    """``items`` bounds the benchmark items of one pass over the documents, further ones take further
    passes. The space has ``rank`` dimensions of the passages and one for each item of the pass."""

    bits: int = 18
    rank: int = 128
    items: int = 256
    overlap: float = 0.8
    overlap_with_answer: float = 0.55
    answer: float = 0.8
    least_words: int = 8


_PART = 4096
#: Arrays that one group sums.
_LANE = 128
#: Terms whose entries are multiplied as dense columns, the commonest, as most words of a text are of few terms;
#: and cells that these may have for each entry, so that short lines get fewer of such columns.
_DENSE, _CELLS = 256, 16
#: Segments that are summed together, entry by entry; fewer are summed one by one.
_FEW = 16
_ENDS = np.isin(np.arange(256), np.frombuffer(b".!?\n", np.uint8))


def _buckets(data: np.ndarray, places: np.ndarray, bits: int) -> tuple[words.Words, np.ndarray, np.ndarray]:
    found = words.find_words(data, places, words.ALNUM)
    hashed = words.hash_words(data, found, lower=True)[0]
    return found, hashed, (hashed & np.uint64((1 << bits) - 1)).astype(np.int64)


def _sum_parts(rows: DataFrame, kind: str) -> np.ndarray:
    """Sum of arrays that came as ``part int, values binary``, part by part.

    Each task gives one array per part, so their number grows with the input. They are summed over
    ``_LANE`` neighbouring tasks first, then over as many of those sums, and so on, and no group holds
    more than ``_LANE`` arrays until the last, of one array per ``_LANE ** 2`` tasks.
    """

    def summed(rows: DataFrame, kind: str, *by: str) -> DataFrame:
        def add(group: pa.Table) -> pa.Table:
            total = np.zeros(1)
            for value in group.column("values"):
                total = total + np.frombuffer(value.as_buffer(), kind)
            return group.slice(0, 1).set_column(2, "values", pa.array([total.tobytes()], pa.binary()))

        return rows.groupBy(*by).applyInArrow(add, "part int, lane int, values binary")

    lanes = F.expr(f"cast(lane div {_LANE} as int)")
    sums = rows.select("part", F.spark_partition_id().alias("lane"), "values").withColumn("lane", lanes)
    sums = summed(sums, kind, "part", "lane").withColumn("lane", lanes)
    sums = summed(summed(sums, "f8", "part", "lane"), "f8", "part")
    parts = sorted(sums.select("part", "values").collect())
    return np.concatenate([np.frombuffer(v, "f8") for _, v in parts]) if parts else np.zeros(0)


def document_frequencies(docs: DataFrame, bits: int) -> np.ndarray:
    """In how many documents each bucket of words occurs, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, _, data, places in words.blocks(batch):
                found, _, bucket = _buckets(data, places, bits)
                keys = np.sort((found.text << bits) | bucket)
                new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
                counts += np.bincount(keys[new] & ((1 << bits) - 1), minlength=1 << bits)
        if counts.any():
            values = [counts[a : a + _PART].astype(np.int32).tobytes() for a in range(0, 1 << bits, _PART)]
            parts = pa.array(range(len(values)), pa.int32())
            yield pa.RecordBatch.from_arrays([parts, pa.array(values, pa.binary())], ["part", "values"])

    counts = _sum_parts(tables.in_batches(docs.select("text"), run, "part int, values binary"), "i4")
    return counts if len(counts) else np.zeros(1 << bits)


def passages(docs: DataFrame, idf: Broadcast, terms: np.ndarray, params: LeakParams) -> DataFrame:
    """The matrix of the lines of all documents, in blocks ``sizes, terms, norms``: per line the number
    of its words that are terms and the length of its vector over all its words, and those terms."""
    shipped = tables.ship(docs.sparkSession, {"terms": terms.tobytes()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = np.full(1 << params.bits, -1, np.int32)
        known = np.frombuffer(shipped.value["terms"], np.int64)
        index[known] = np.arange(len(known))
        weight = np.frombuffer(idf.value["idf"], "f4")
        for batch in batches:
            for _, _, data, places in words.blocks(batch):
                lines = np.sort(np.concatenate([places, np.flatnonzero(data == 10) + 1]))
                found, _, bucket = _buckets(data, lines, params.bits)
                norm = np.sqrt(words.sums_by(weight[bucket] ** 2, found.first)) + 1e-9
                term = index[bucket]
                inside = np.append(0, np.cumsum(term >= 0))
                sizes = np.diff(inside[found.first])
                some = sizes > 0
                arrays = sizes[some].astype("i4"), term[term >= 0], norm[some].astype("f4")
                values = [pa.array([x.tobytes()], pa.binary()) for x in arrays]
                yield pa.RecordBatch.from_arrays(values, ["sizes", "terms", "norms"])

    return tables.in_batches(docs.select("text"), run, "sizes binary, terms binary, norms binary")


def _products(matrix: DataFrame, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``A' A basis`` for the matrix A of ``passages``, whose rows have length one; ``weight`` is that of terms.

    Columns of at most ``_DENSE`` terms, the commonest, which have the least weight, are multiplied as dense
    ones, all others entry by entry."""
    basis = basis.astype("f4")
    shipped = tables.ship(matrix.sparkSession, {"weight": weight.astype("f4").tobytes(), "basis": basis.tobytes()})
    width = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.frombuffer(shipped.value["weight"], "f4")
        order = np.argsort(weight, kind="stable")
        place = np.argsort(order)
        weighted = (np.frombuffer(shipped.value["basis"], "f4").reshape(-1, width) * weight[:, None])[order]
        total = np.zeros(weighted.shape, np.float64)
        for batch in batches:
            for block in batch.to_pylist():
                sizes, term = np.frombuffer(block["sizes"], "i4"), place[np.frombuffer(block["terms"], "i4")]
                scale = np.frombuffer(block["norms"], "f4") ** -2
                row = np.repeat(np.arange(len(sizes)), sizes)
                for a, b in zip(*_spans(row, 8_000)):
                    low, high = row[a], row[b - 1] + 1
                    of, at = row[a:b] - low, term[a:b]
                    dense = min(_DENSE, len(order), _CELLS * (b - a) // (high - low))
                    common = at < dense
                    cells = np.bincount(of[common] * dense + at[common], minlength=(high - low) * dense)
                    cells = cells.reshape(-1, dense).astype("f4")
                    of, at = of[~common], at[~common]
                    image = cells @ weighted[:dense]
                    _add_rows(image, of, weighted, at)
                    image *= scale[low:high, None]
                    total[:dense] += cells.T @ image
                    by = np.argsort(at, kind="stable")
                    _add_rows(total, at[by], image, of[by])
        if total.any():
            total = total[place] * weight[:, None]
            parts = [total[a : a + _PART].astype("f4").tobytes() for a in range(0, len(total), _PART)]
            numbers = pa.array(range(len(parts)), pa.int32())
            yield pa.RecordBatch.from_arrays([numbers, pa.array(parts, pa.binary())], ["part", "values"])

    product = _sum_parts(tables.in_batches(matrix, run, "part int, values binary"), "f4")
    return product.reshape(-1, width) if len(product) else np.zeros(basis.shape)


def _add_rows(total: np.ndarray, at: np.ndarray, rows: np.ndarray, of: np.ndarray) -> None:
    """``total[at[i]] += rows[of[i]]`` for each i; ``at`` ascends. First the first entries of all segments of
    equal ``at`` are added, then their second ones, and so on, and at last what a few long segments have left."""
    begins = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
    sizes = np.diff(np.append(begins, len(at)))
    order = np.argsort(-sizes, kind="stable")
    begins, sizes, n = begins[order], sizes[order], 0
    while (left := int(np.searchsorted(-sizes, -n, "left"))) > _FEW:  # those with more than n
        some = begins[:left]
        total[at[some]] += rows[of[some + n]]
        n += 1
    if left:
        some, sizes = begins[:left], sizes[:left] - n
        opens = np.cumsum(sizes) - sizes
        place = np.repeat(some + n - opens, sizes) + np.arange(sizes.sum())
        total[at[some]] += np.add.reduceat(rows[of[place]], opens, axis=0)


def _spans(row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of spans of about ``size`` entries that part no row from itself."""
    edges = np.unique(np.searchsorted(row, row[::size])) if len(row) else np.zeros(0, np.int64)
    return edges, np.append(edges[1:], len(row))


def latent_space(matrix: DataFrame, weight: np.ndarray, items: np.ndarray, params: LeakParams) -> np.ndarray:
    """Right singular vectors of the passages, one row per term, and after them what the columns of ``items``
    have outside these."""
    return np.linalg.qr(np.hstack([singular_vectors(matrix, weight, params), items]))[0].astype(np.float32)


def singular_vectors(matrix: DataFrame, weight: np.ndarray, params: LeakParams) -> np.ndarray:
    """Randomised decomposition in two passes over the passages.

    The first finds a basis near the leading vectors. The product of the second, Y, with the basis Q gives the
    Nyström form ``Y (Q' Y)^-1 Y'`` of ``A' A``, whose vectors are those of Y divided by the root of the core:
    as exact as a further pass that only projected."""
    width = min(params.rank + 8, len(weight))
    basis = np.random.default_rng(2).normal(size=(len(weight), width))
    basis = np.linalg.qr(_products(matrix, weight, basis) + 1e-9 * basis)[0]
    product = _products(matrix, weight, basis)
    product += (1e-6 * np.linalg.norm(product) + 1e-9) * basis  # keeps the core positive
    core = basis.T @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-12))
    return np.linalg.svd(product @ root, full_matrices=False)[0][:, : params.rank]


def item_vectors(index: np.ndarray, idf: np.ndarray, bucket: np.ndarray, first: np.ndarray, terms: int) -> np.ndarray:
    """TF-IDF of each item, a column of ``terms`` rows."""
    vectors = np.zeros((terms, len(first) - 1))
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    np.add.at(vectors, (index[bucket], of), idf[bucket])
    return vectors


def common_subsequence(places: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence of ``text`` and a sequence of ``size`` words, given
    as the bits of each word's places; a word of the text takes a few operations on whole numbers."""
    full = (1 << size) - 1
    free = full
    for word in text:
        taken = free & places.get(word, 0)
        free = (free + taken | free - taken) & full
    return size - free.bit_count()


def _bits(hashed: list[int]) -> dict[int, int]:
    places: dict[int, int] = {}
    for i, word in enumerate(hashed):
        places[word] = places.get(word, 0) | 1 << i
    return places


def least_share(gain: np.ndarray, answer: int, params: LeakParams) -> float:
    """The least sum of ``gain``, a value per word of an item, the last ``answer`` of which are its
    answer's, over any words of it that are enough for the decision."""
    size = len(gain)
    if size < params.least_words:
        return float(gain.sum())
    whole = np.sort(gain)[: _enough(params.overlap, size)].sum()
    # With the answer: the lightest words of it that are enough, then the lightest of all others.
    own = np.sort(gain[size - answer :])
    taken = _enough(params.answer, answer)
    others = np.sort(np.concatenate([gain[: size - answer], own[taken:]]))
    more = max(0, _enough(params.overlap_with_answer, size) - taken)
    return float(min(whole, own[:taken].sum() + others[:more].sum()))


def _enough(share: float, size: int) -> int:
    """The least number whose share of ``size`` reaches ``share``."""
    return next(n for n in range(size + 1) if n / size >= share)


@dataclass
class Item:
    number: int
    size: int
    places: dict[int, int]
    answer: dict[int, int]
    answer_size: int


#: What rounding may take from a share.
_SLACK = 1e-3
_ONE = np.uint64(1)


class Searcher:
    """Finds the items of one pass in texts. Made once per task from what was shipped."""

    def __init__(self, model: dict[str, bytes], params: LeakParams):
        self.params, self.idf = params, np.frombuffer(model["idf"], "f4")
        terms = np.frombuffer(model["terms"], np.int64)
        self.index = np.full(1 << params.bits, -1)
        self.index[terms] = np.arange(len(terms))
        self.space = np.frombuffer(model["space"], "f4").reshape(len(terms), -1)
        sizes = np.frombuffer(model["sizes"], np.int64)
        data, places = np.frombuffer(model["texts"], np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        found, hashed, bucket = _buckets(data, places, params.bits)
        ends = np.concatenate([[0], np.cumsum(_ENDS[data])])
        self.weight = self.idf[terms]
        vectors = item_vectors(self.index, self.idf, bucket, found.first, len(terms))
        self.images = self.space.T @ vectors
        squares = np.maximum((self.images**2).sum(axis=0), 1e-9)
        # What a word adds to the share of an item that is there. A text with all words has 1.
        self.gain = ((self.space @ self.images) * self.weight[:, None] / squares).astype("f4")
        self.gain[vectors == 0] = 0  # but for rounding, as the space holds the items
        self.vocabulary, word = np.unique(hashed, return_inverse=True)
        self.masks = np.zeros((len(found.first) - 1, len(self.vocabulary)), np.uint64)
        self.items, least = [], []
        for i, (a, b) in enumerate(zip(found.first.tolist(), found.first[1:].tolist())):
            opens = np.flatnonzero(ends[found.starts[a + 1 : b]] > ends[found.ends[a : b - 1]])
            answer = hashed[a + 1 + opens[-1] if len(opens) else a : b].tolist()
            self.items.append(Item(i, b - a, _bits(hashed[a:b].tolist()), _bits(answer), len(answer)))
            np.bitwise_or.at(self.masks[i], word[a : min(b, a + 64)], _ONE << np.arange(min(b - a, 64), dtype=np.uint64))
            at = self.index[bucket[a:b]]
            own = vectors[at, i] * self.idf[bucket[a:b]] / max(float((vectors[:, i] ** 2).sum()), 1e-9)
            least.append(least_share(own, len(answer), params) - _SLACK)
        self.least, self.sizes = np.where(np.diff(found.first) > 0, least, np.inf), np.diff(found.first)
        self.lengths = np.array([1 << n.bit_length() - 1 if n else 1 for n in self.sizes.tolist()])
        # The items each term is of, and how often.
        at, self.holders = np.nonzero(vectors)
        self.held, self.holder_gain = np.searchsorted(at, np.arange(len(terms) + 1)), self.gain[at, self.holders]
        self.times = np.rint(vectors[at, self.holders] / np.maximum(self.weight[at], 1e-9)).astype(np.int64)
        # Words of the longest stretch that is compared with an item, and those that begin a stretch in a piece of text.
        self.reach = int((self.lengths + 2 * self.sizes).max(initial=1))
        self.piece = 4 * self.reach
        share = min(params.overlap, params.overlap_with_answer)
        self.least_count = np.array([_enough(share, n) if n >= params.least_words else n for n in self.sizes.tolist()])

    def search(self, data: np.ndarray, places: np.ndarray) -> list[list[dict]]:
        """For each text, the items it holds."""
        found, hashed, bucket = _buckets(data, places, self.params.bits)
        out: list[list[dict]] = [[] for _ in range(len(places) - 1)]
        term = self.index[bucket]
        count = np.concatenate([[0], np.cumsum(term >= 0)])
        known = term[term >= 0]
        text, number, begin, end = pieces = self._pieces(found.first)
        sizes = count[end] - count[begin]
        at = np.repeat(count[begin] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        of = np.repeat(np.arange(len(text)), sizes)
        piece, item = np.divmod(np.flatnonzero(self._possible(known[at], of, len(text))), len(self.items))
        maybe = []
        for low, high in zip(*_spans(np.cumsum(sizes[piece]) // 200_000, 1)):
            chosen = [x[piece[low:high]] for x in pieces]
            maybe.append(self._windows(*chosen, item[low:high], found.first, count, known))
        if maybe:
            self._check([np.concatenate(x) for x in zip(*maybe)], found, hashed, term, data, places, out)
        return out

    def _pieces(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``text, number, begin, end`` of pieces of texts. A stretch that begins among the first ``piece`` words
        of one lies in it whole, and any stretch in the last one lies there too."""
        sizes = np.diff(first)
        pieces = np.maximum(1, -(-(sizes - self.reach) // self.piece))
        text = np.repeat(np.arange(len(sizes)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first[text] + number * self.piece
        return text, number, begin, np.minimum(begin + self.piece + self.reach, first[text + 1])

    def _possible(self, known: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
        """Whether a piece of a text has enough of an item's words, by share and by number, each as often as
        the item at most; no stretch of it has more."""
        share, number = np.zeros((2, texts * len(self.items)))
        keys = np.sort(text * len(self.weight) + known)
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        often = np.diff(np.append(begins, len(keys)))
        text, known = np.divmod(keys[begins], len(self.weight))
        for low in range(0, len(known), 50_000):
            at = known[low : low + 50_000]
            sizes = np.diff(self.held)[at]
            place = np.repeat(self.held[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            first = int(text[low]) * len(self.items)
            key = np.repeat(text[low : low + 50_000] * len(self.items) - first, sizes) + self.holders[place]
            times = np.minimum(np.repeat(often[low : low + 50_000], sizes), self.times[place])
            for total, values in ((share, times * self.holder_gain[place]), (number, times)):
                some = np.bincount(key, values)
                total[first : first + len(some)] += some
        share, number = share.reshape(texts, -1), number.reshape(texts, -1)
        return (share >= self.least) & (number >= self.least_count)

    def _windows(
        self,
        text: np.ndarray,
        number: np.ndarray,
        opens: np.ndarray,
        closes: np.ndarray,
        item: np.ndarray,
        first: np.ndarray,
        count: np.ndarray,
        known: np.ndarray,
    ) -> list[np.ndarray]:
        """``text, item, begin, end, share, own`` of the windows, a quarter of a window apart, that with as many
        words on both sides as the item has may hold it, where these words begin in the piece of the text.
        ``share`` is that of all these words, ``own`` that of the window's."""
        sizes = count[closes] - count[opens]
        base = np.cumsum(sizes) - sizes
        at = np.repeat(count[opens] - base, sizes) + np.arange(sizes.sum())
        sums = np.concatenate([[0], np.cumsum(self.gain[known[at], np.repeat(item, sizes)], dtype=np.float64)])
        length, size = self.lengths[item], self.sizes[item]
        words_ = first[text + 1] - first[text]
        step, left = np.maximum(1, length // 4), np.maximum(0, words_ - length)
        windows = 1 + -(-left // step)

        def before(number: np.ndarray) -> np.ndarray:
            """How many windows of the text have stretches that begin before a piece."""
            some = number * self.piece + size
            return np.where(number == 0, 0, np.where(left < some, windows, -(-some // step)))

        last = (number + 1) * self.piece >= words_ - self.reach
        skipped = before(number)
        windows = np.where(last, windows, before(number + 1)) - skipped
        pair = np.repeat(np.arange(len(text)), windows)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(windows) - windows - skipped, windows)
        begin = first[text[pair]] + np.minimum(at * step[pair], left[pair])
        end = np.minimum(begin + length[pair], first[text[pair] + 1])
        low, high = self._stretch(text[pair], item[pair], begin, end, first)
        shift = (base - count[opens])[pair]
        share = sums[count[high] + shift] - sums[count[low] + shift]
        near = share >= self.least[item[pair]]
        pair, begin, end, share, shift = (x[near] for x in (pair, begin, end, share, shift))
        own = sums[count[end] + shift] - sums[count[begin] + shift]
        return [text[pair], item[pair], begin, end, share.round(6), own.round(6)]

    def _stretch(self, text, item, begin, end, first) -> tuple[np.ndarray, np.ndarray]:
        size = self.sizes[item]
        return np.maximum(begin - size, first[text]), np.minimum(end + size, first[text + 1])

    def _check(
        self,
        maybe: list[np.ndarray],
        found: words.Words,
        hashed: np.ndarray,
        term: np.ndarray,
        data: np.ndarray,
        places: np.ndarray,
        out: list[list[dict]],
    ) -> None:
        """Compares all windows that may hold an item with it, the best first, until one does. Neighbouring
        windows are compared as one first: what it doesn't have, none of them has."""
        text, item, begin, end, share, own = maybe
        low, high = self._stretch(text, item, begin, end, found.first)
        inside, word = self._vocabulary_words(low, high, hashed, term)
        keys = np.stack([text, item, low // self.sizes[item]])
        opens = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))[: len(text)])
        if len(opens):
            near = self._near(item[opens], low[opens], np.maximum.reduceat(high, opens), inside, word)
            near = np.repeat(near, np.diff(np.append(opens, len(text))))
            text, item, begin, end, share, own, low, high = (
                x[near] for x in (text, item, begin, end, share, own, low, high)
            )
        near = np.flatnonzero(self._near(item, low, high, inside, word))
        order = near[np.lexsort((begin[near], -own[near], -share[near], item[near], text[near]))]
        done = None
        for k in order.tolist():
            at, number, a, b = int(text[k]), int(item[k]), int(begin[k]), int(end[k])
            if (at, number) == done:
                continue
            leak = self._compare(self.items[number], hashed, found, at, a, b)
            if leak:
                done, start = (at, number), places[at]
                first = len(data[start : found.starts[leak["a"]]].tobytes().decode())
                last = len(data[start : found.ends[leak["b"] - 1]].tobytes().decode())
                kept = {"item": number, "overlap": leak["overlap"], "answer": leak["answer"]}
                out[at].append(kept | {"cosine": self._cosine(term[a:b], number), "begin": first, "end": last})

    def _vocabulary_words(
        self, low: np.ndarray, high: np.ndarray, hashed: np.ndarray, term: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words of any item in these stretches, ascending, and which words they are."""
        edges = np.bincount(low, minlength=len(term) + 1) - np.bincount(high, minlength=len(term) + 1)
        inside = np.flatnonzero((np.cumsum(edges)[:-1] > 0) & (term >= 0))
        word = np.searchsorted(self.vocabulary, hashed[inside])
        same = self.vocabulary[np.minimum(word, len(self.vocabulary) - 1)] == hashed[inside]
        return inside[same], word[same]

    def _near(self, item: np.ndarray, low: np.ndarray, high: np.ndarray, inside: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Whether a stretch of words has as much of an item as the decision asks for at least."""
        least = min(self.params.overlap, self.params.overlap_with_answer)
        size = self.sizes[item]
        return (self._overlaps(item, low, high, inside, word) / size >= least) | (size > 64)

    def _overlaps(self, item: np.ndarray, low: np.ndarray, high: np.ndarray, inside: np.ndarray, word: np.ndarray) -> np.ndarray:
        """``common_subsequence`` of each item and its stretch of words, for items of at most 64 words."""
        left, right = np.searchsorted(inside, low), np.searchsorted(inside, high)
        order = np.argsort(left - right, kind="stable")
        item, left, count = item[order], left[order], (right - left)[order]
        full = ~np.uint64(0) >> (np.uint64(64) - np.minimum(self.sizes, 64).astype(np.uint64))[item]
        free = full.copy()
        for n in range(int(count[0]) if len(count) else 0):
            k = int(np.searchsorted(-count, -n, "left"))  # those with more than n words
            some = free[:k]
            taken = some & self.masks[item[:k], word[left[:k] + n]]
            free[:k] = (some + taken | some & ~taken) & full[:k]
        out = np.zeros(len(order), np.int64)
        out[order] = np.minimum(self.sizes, 64)[item] - np.bitwise_count(free)
        return out

    def _cosine(self, term: np.ndarray, item: int) -> float:
        """Of a window and an item, in the space."""
        known = term[term >= 0]
        image = self.weight[known] @ self.space[known]
        norms = float(np.linalg.norm(image) * np.linalg.norm(self.images[:, item]))
        return float(image @ self.images[:, item]) / norms if norms else 0.0

    def _compare(self, item: Item, hashed: np.ndarray, found: words.Words, text: int, a: int, b: int) -> dict | None:
        params = self.params
        a, b = max(a - item.size, int(found.first[text])), min(b + item.size, int(found.first[text + 1]))
        region = hashed[a:b].tolist()
        overlap = common_subsequence(item.places, item.size, region) / item.size
        answer = common_subsequence(item.answer, item.answer_size, region) / item.answer_size
        least = params.overlap if item.size >= params.least_words else 1.0
        if overlap >= least or item.size >= params.least_words and (
            overlap >= params.overlap_with_answer and answer >= params.answer
        ):
            return {"overlap": overlap, "answer": answer, "a": a, "b": b}
        return None


def find_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """All rows and columns of ``docs``, and ``leaks``, the items found in each text, as structs of
    ``item_id, cosine, overlap, answer, begin, end``.

    ``overlap`` and ``answer`` are the shares of the item's words, and of its last sentence's, that
    the text between the characters ``begin`` and ``end`` has in the same order. Items of fewer than
    ``least_words`` words must be there whole. NULL texts and items without words match nothing; an
    item that occurs twice is found twice; without documents or items there are no leaks. Each row
    is searched by its text alone, so repeated rows and NULL ids are like others.
    """
    spark, name = docs.sparkSession, tables.unused("leaks", docs)
    narrow = docs.select("text")
    total = narrow.count()
    counts = document_frequencies(narrow, params.bits)
    idf = np.log((total + 1) / (counts + 1)).astype("f4") + np.float32(0.05)
    shipped = tables.ship(spark, {"idf": idf.tobytes()})
    items = benchmark.filter("text is not null").select("item_id", "text")
    passes = max(1, -(-items.count() // params.items))
    work = tables.Workspace(spark)
    span = "item_id: bigint, cosine: double, overlap: double, answer: double, begin: bigint, end: bigint"
    out = docs.withColumn(name, F.expr(f"cast(array() as array<struct<{span}>>)"))
    for number in range(passes):
        chosen = items.filter(F.pmod(F.xxhash64("text"), F.lit(passes)) == number).orderBy("item_id", "text")
        rows = [(r.item_id, r.text.encode()) for r in chosen.collect()]
        data = np.frombuffer(b"".join(t for _, t in rows), np.uint8)
        sizes = np.array([len(t) for _, t in rows], np.int64)
        places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        found, _, bucket = _buckets(data, places, params.bits)
        terms = np.unique(bucket)
        if not len(terms):
            continue
        vectors = item_vectors(np.searchsorted(terms, np.arange(1 << params.bits)), idf, bucket, found.first, len(terms))
        matrix = work.store(passages(narrow, shipped, terms, params))
        space = latent_space(matrix, idf[terms], vectors, params)
        work.drop(matrix)
        model = {"terms": terms.tobytes(), "space": space.tobytes(), "texts": data.tobytes(), "sizes": sizes.tobytes()}
        out = _searched(out, tables.ship(spark, model | {"idf": idf.tobytes()}), [i for i, _ in rows], params)
    return out


def _searched(docs: DataFrame, model: Broadcast, ids: list[int | None], params: LeakParams) -> DataFrame:
    """``docs``, whose last column gets the items of one pass that were found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(model.value, params)
        for batch in batches:
            at = batch.num_columns - 1
            leaks = batch.column(at).to_pylist()
            for begin, _, data, places in words.blocks(batch):
                for i, items in enumerate(searcher.search(data, places)):
                    leaks[begin + i] += [{"item_id": ids[x.pop("item")]} | x for x in items]
            yield batch.set_column(at, batch.schema.field(at), pa.array(leaks, batch.schema.field(at).type))

    return tables.in_batches(docs, run, docs.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """``doc_id, item_id, cosine, overlap, answer, begin, end``, a row per item found in a row."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, params)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
