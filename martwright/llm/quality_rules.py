"""Quality rules: countable base rules, then a calibrated classifier of word and character n-grams.

The classifier is a logistic regression over hashed frequencies of words, word pairs and byte
triples, trained on labelled rows; Platt scaling on rows it wasn't fitted to turns its score into a
probability, which is held against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martwright.llm import linear, tables, words


@dataclass(frozen=True)
class RuleParams:
    """``sample`` bounds the labelled documents learned from."""

    sample: int = 4000
    word_bits: int = 17
    byte_bits: int = 15
    rounds: int = 60
    threshold: float = 0.5
    least_words: int = 50
    largest_repeat_percent: int = 50


#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_CONTINUES = bytes(range(0x80, 0xC0))


def base_counts(data: np.ndarray, places: np.ndarray, found: words.Words, hashed: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per text; words are runs of anything but white space of ASCII."""
    n, raw = len(places) - 1, data.tobytes()
    chars, symbols, twice = (np.zeros(n, np.int64) for _ in range(3))
    for i in range(n):
        text = raw[places[i] : places[i + 1]]
        chars[i] = len(text.translate(None, words.SPACES + _CONTINUES))
        symbols[i] = len(text) - len(text.translate(None, SYMBOLS))
        lines = [line for line in text.split(b"\n") if line.strip()]
        twice[i] = len(lines) - len(set(lines))
    sizes = np.diff(found.first)
    windows = np.maximum(sizes - 2, 0)
    ends = np.cumsum(windows)
    at = np.repeat(found.first[:-1] - (ends - windows), windows) + np.arange(ends[-1] if n else 0)
    key = words.stretches(hashed, at, at + 3) ^ words.mix(np.repeat(np.arange(n), windows).astype(np.uint64))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    again = np.zeros(len(hashed), bool)
    starts = at[count[which] > 1]
    for k in range(3):
        again[starts + k] = True
    return {
        "n_words": sizes.astype(np.int64),
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": twice,
        "n_repeat_words": words.sums_by(again, found.first).astype(np.int64),
    }


def _buckets(data: np.ndarray, found: words.Words, hashed: np.ndarray, params: RuleParams) -> tuple:
    """Buckets of words and pairs, those of byte triples, and the first of either in each text."""
    same = np.zeros(len(hashed), bool)
    same[1:] = hashed[1:] == hashed[:-1]
    pair = words.mix(hashed * np.uint64(3) + np.concatenate([hashed[1:], hashed[:1]]))
    pair[same] = 1  # a word said twice is the same pair whatever the word
    span = np.uint64((1 << params.word_bits) - 1)
    word = np.stack([words.mix(hashed) & span, pair & span], axis=1).astype(np.int32)
    triple = data.astype(np.uint32) if len(data) > 2 else np.zeros(0, np.uint32)
    triple = (triple[:-2] * np.uint32(65599) + triple[1:-1]) * np.uint32(65599) + triple[2:] if len(triple) else triple
    triple = (triple * np.uint32(2654435761)) >> np.uint32(32 - params.byte_bits)
    return word, triple.astype(np.int32) + (1 << params.word_bits)


def fit(batches: Iterator[pa.RecordBatch], params: RuleParams) -> dict[str, bytes]:
    dims = (1 << params.word_bits) + (1 << params.byte_bits)
    parts, labels = [], []
    for batch in batches:
        label = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
        for begin, end, data, places in words.blocks(batch):
            found = words.find_words(data, places)
            hashed = words.hash_words(data, found)[0]
            word, triple = _buckets(data, found, hashed, params)
            rows = []
            for i in range(end - begin):
                w = word[found.first[i] : found.first[i + 1]].ravel()
                t = triple[places[i] : max(places[i + 1] - 2, places[i])]
                for kind in (w, t):
                    index, count = np.unique(kind, return_counts=True)
                    rows.append((index, (count / max(len(kind), 1) * _SCALE).astype(np.float32)))
            parts += rows
            labels.extend(label[begin:end])
    y = np.array(labels, np.int64)
    weights, bias, platt = np.zeros(dims), np.full(1, 3.0), (1.0, 0.0)
    if 0 < y.sum() < len(y):
        sizes = [len(a[0]) + len(b[0]) for a, b in zip(parts[::2], parts[1::2])]
        x = linear.Sparse(
            np.concatenate([p[0] for p in parts]),
            np.concatenate([p[1] for p in parts]),
            np.concatenate([[0], np.cumsum(sizes)]),
        )
        fitted = np.arange(len(y)) % 5 != 0
        kept = fitted[x.row]
        part = linear.Sparse(x.index[kept], x.value[kept], np.concatenate([[0], np.cumsum(np.array(sizes)[fitted])]))
        if 0 < y[fitted].sum() < fitted.sum():
            weights, bias = linear.fit_logistic(part, y[fitted], dims, params.rounds)
            weights = weights[:, 0]
            z = bias[0] + np.bincount(x.row, weights[x.index] * x.value, len(y))
            platt = linear.fit_platt(z[~fitted], y[~fitted])
    return {
        "weights": weights.astype(np.float32).tobytes(),
        "line": np.array([bias[0], *platt], np.float64).tobytes(),
    }


_SCALE = 20.0


def train(docs: DataFrame, labels: DataFrame, params: RuleParams = RuleParams()) -> dict[str, bytes]:
    """A model of ``labels.quality``; without labelled documents of both kinds it keeps everything."""
    sample = tables.labelled_sample(docs, labels, "quality", params.sample)
    return tables.fit_in_one_task(sample, lambda batches: fit(batches, params))


def apply_rules(docs: DataFrame, model: dict[str, bytes], params: RuleParams = RuleParams()) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``probability`` and ``kept`` of every row.

    NULL texts have no words, as empty ones, and fail the base rules. Repeated rows stay.
    """
    shipped = tables.ship(docs.sparkSession, model)
    ddl = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, probability double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shipped.value["weights"], np.float32)
        bias, slope, offset = np.frombuffer(shipped.value["line"], np.float64)
        for batch in batches:
            for begin, end, data, places in words.blocks(batch):
                found = words.find_words(data, places)
                hashed = words.hash_words(data, found)[0]
                out = base_counts(data, places, found, hashed)
                n = out["n_words"]
                failed = (n < params.least_words) | (100 * out["n_repeat_words"] > params.largest_repeat_percent * n)
                word, triple = _buckets(data, found, hashed, params)
                by_word = words.sums_by(weights[word].sum(axis=1), found.first) / np.maximum(2 * n, 1)
                last = np.maximum(places[1:] - 2, places[:-1])
                sums = np.concatenate([[0], np.cumsum(weights[triple], dtype=np.float64)])
                at = lambda p: sums[np.minimum(p, len(triple))]
                by_byte = (at(last) - at(places[:-1])) / np.maximum(last - places[:-1], 1)
                chance = linear.logistic(slope * (bias + _SCALE * (by_word + by_byte)) + offset)
                out |= {"base_failed": failed, "kept": ~failed & (chance >= params.threshold), "probability": chance}
                ids = batch.column(batch.schema.get_field_index("doc_id")).slice(begin, end - begin)
                yield pa.RecordBatch.from_pydict({"doc_id": ids} | out)

    narrow = docs.select("doc_id", "text")
    return narrow.mapInArrow(run, tables.arrow_fields(narrow.select("doc_id"), ddl))


def quality_rules(docs: DataFrame, labels: DataFrame, params: RuleParams = RuleParams()) -> DataFrame:
    return apply_rules(docs, train(docs, labels, params), params)
