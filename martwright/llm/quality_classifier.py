"""Quality by a factorisation machine over hashed words, structure and metadata.

Every pair of features interacts through the product of two short vectors. By the identity
``sum_{i<j} <v_i, v_j> x_i x_j = ((sum_i v_i x_i)^2 - sum_i (v_i x_i)^2) / 2`` a document is scored
in time linear in its distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import linear, tables, words


@dataclass(frozen=True)
class QualityParams:
    """``sample`` bounds the labelled documents learned from; ``rank`` is the length of the vectors."""

    sample: int = 4000
    bits: int = 16
    rank: int = 8
    rounds: int = 50
    rate: float = 0.1
    decay: float = 1e-4
    threshold: float = 0.3


_CLASSES = np.stack(
    [
        [chr(b).isupper() and b < 128 for b in range(256)],
        [chr(b).islower() and b < 128 for b in range(256)],
        [48 <= b < 58 for b in range(256)],
        [b in b"#*$%&|<>" for b in range(256)],
        [b in b".,;:!?" for b in range(256)],
        [b == 10 for b in range(256)],
        [b >= 192 for b in range(256)],
    ],
    axis=1,
).astype(np.float64)
#: Structure: shares of byte classes, words, distinct words, words said twice in a row, their
#: length, repeated lines; then the metadata and whether it is missing.
STATISTICS = _CLASSES.shape[1] + 7


def features(batch: pa.RecordBatch, begin: int, data: np.ndarray, places: np.ndarray, params: QualityParams):
    """Distinct hashed words of each text, and the table of its statistics."""
    n = len(places) - 1
    found = words.find_words(data, places)
    hashed = words.hash_words(data, found, lower=True)[0]
    bag = linear.counted((hashed & np.uint64((1 << params.bits) - 1)).astype(np.int64), found.first, 1 << params.bits)
    bag.value = np.repeat(1 / np.sqrt(np.maximum(np.diff(bag.first), 1)), np.diff(bag.first)).astype(np.float32)
    size, sizes = np.diff(places), np.diff(found.first)
    stats = np.zeros((n, STATISTICS))
    raw = data.tobytes()
    for i in range(n):
        text = raw[places[i] : places[i + 1]]
        stats[i, : _CLASSES.shape[1]] = np.bincount(data[places[i] : places[i + 1]], minlength=256) @ _CLASSES
        lines = [line for line in text.split(b"\n") if line.strip()]
        stats[i, -1] = 1 - len(set(lines)) / max(len(lines), 1)
    stats[:, : _CLASSES.shape[1]] /= np.maximum(size, 1)[:, None]
    same = np.zeros(len(hashed), bool)
    same[1:] = hashed[1:] == hashed[:-1]
    stats[:, -7] = np.log1p(sizes)
    stats[:, -6] = np.diff(bag.first) / np.maximum(sizes, 1)
    stats[:, -5] = words.sums_by(same, found.first) / np.maximum(sizes, 1)
    stats[:, -4] = size / np.maximum(sizes, 1) / 10
    at = batch.schema.get_field_index("n_chars")
    known = batch.column(at).slice(begin, n).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    stats[:, -3] = np.log1p(np.maximum(np.nan_to_num(known), 0))
    stats[:, -2] = np.isnan(known)
    return bag, stats


def _standard(stats: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((stats - mean) / spread, -4, 4)


def _joined(bag: linear.Sparse, stats: np.ndarray, dims: int) -> linear.Sparse:
    """Words and statistics of each row side by side; statistics come after the ``dims`` buckets."""
    n, k = stats.shape
    sizes = np.diff(bag.first)
    first = np.concatenate([[0], np.cumsum(sizes + k)])
    index, value = np.zeros(first[-1], np.int32), np.zeros(first[-1], np.float32)
    at = np.arange(len(bag.index)) + np.repeat(np.arange(n) * k, sizes)
    index[at], value[at] = bag.index, bag.value
    at = (first[1:] - k)[:, None] + np.arange(k)
    index[at], value[at] = dims + np.arange(k), stats
    return linear.Sparse(index, value, first)


def factorise(x: linear.Sparse, bias: float, weights: np.ndarray, vectors: np.ndarray) -> tuple:
    """Logits, and the sums of vectors they are made of."""
    plain = words.sums_by(weights[x.index] * x.value, x.first)
    own = vectors[x.index] * x.value[:, None]
    sums = words.sums_by(own, x.first)
    squares = words.sums_by((own**2).sum(axis=1), x.first)
    return bias + plain + ((sums**2).sum(axis=1) - squares) / 2, sums


def fit(batches: Iterator[pa.RecordBatch], params: QualityParams) -> dict[str, bytes]:
    dims = 1 << params.bits
    bags, stats, labels = [], [np.zeros((0, STATISTICS))], []
    for batch in batches:
        label = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
        for begin, end, data, places in words.blocks(batch):
            bag, table = features(batch, begin, data, places, params)
            bags.append(bag)
            stats.append(table)
            labels.extend(label[begin:end])
    y, table = np.array(labels, np.float64), np.concatenate(stats)
    weights = np.zeros(dims + STATISTICS)
    vectors = np.random.default_rng(7).normal(0, 0.1, (dims + STATISTICS, params.rank))
    bias, mean, spread = 3.0, np.zeros(STATISTICS), np.ones(STATISTICS)
    if 0 < y.sum() < len(y):
        mean, spread = table.mean(axis=0), table.std(axis=0) + 1e-6
        x = _joined(linear.Sparse.stack(bags), _standard(table, mean, spread), dims)
        bias = _descend(x, y, weights, vectors, params)
    return {
        "bias": np.float64(bias).tobytes(),
        "weights": weights.astype(np.float32).tobytes(),
        "vectors": vectors.astype(np.float32).tobytes(),
        "scaling": np.stack([mean, spread]).tobytes(),
    }


def _descend(x: linear.Sparse, y: np.ndarray, weights: np.ndarray, vectors: np.ndarray, params: QualityParams) -> float:
    """Adaptive gradient steps in place; returns the bias."""
    row, n, dims = x.row, len(y), len(weights)
    bias, bias_square = float(np.log((y.sum() + 1) / (n - y.sum() + 1))), 1e-8
    squares, vector_squares = np.full(dims, 1e-8), np.full(vectors.shape, 1e-8)
    for _ in range(params.rounds):
        logit, sums = factorise(x, bias, weights, vectors)
        error = (linear.logistic(logit) - y) / n
        pull = error[row] * x.value
        grad = np.bincount(x.index, pull, dims) + params.decay * weights
        squares += grad**2
        weights -= params.rate * 2 * grad / np.sqrt(squares)
        square = np.bincount(x.index, pull * x.value, dims)
        for k in range(params.rank):
            grad = np.bincount(x.index, pull * sums[row, k], dims) - square * vectors[:, k]
            grad += params.decay * vectors[:, k]
            vector_squares[:, k] += grad**2
            vectors[:, k] -= params.rate / 4 * grad / np.sqrt(vector_squares[:, k])
        grad = error.sum()
        bias_square += grad**2
        bias -= params.rate * grad / np.sqrt(bias_square)
    return bias


def _inputs(docs: DataFrame) -> DataFrame:
    """Only these reach a score: language, source and id don't. A table may lack ``n_chars``."""
    known = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", "text", known.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> dict[str, bytes]:
    """A model of ``labels.quality``; without labelled documents of both kinds all score alike."""
    text = F.struct("text", "n_chars").alias("text")
    sample = tables.labelled_sample(_inputs(docs).select("doc_id", text), labels, "quality", params.sample)
    return tables.fit_in_one_task(sample.select("text.*", "label"), lambda batches: fit(batches, params))


def score(docs: DataFrame, model: dict[str, bytes], params: QualityParams = QualityParams()) -> DataFrame:
    """``doc_id, score`` of every row; a NULL text counts as an empty one. Repeated rows stay."""
    shipped = tables.ship(docs.sparkSession, model)
    narrow = _inputs(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = {name: shipped.value[name] for name in ("bias", "weights", "vectors", "scaling")}
        bias = float(np.frombuffer(value["bias"])[0])
        weights = np.frombuffer(value["weights"], np.float32)
        vectors = np.frombuffer(value["vectors"], np.float32).reshape(len(weights), params.rank)
        mean, spread = np.frombuffer(value["scaling"]).reshape(2, STATISTICS)
        for batch in batches:
            for begin, end, data, places in words.blocks(batch):
                bag, stats = features(batch, begin, data, places, params)
                x = _joined(bag, _standard(stats, mean, spread), 1 << params.bits)
                ids = batch.column(batch.schema.get_field_index("doc_id")).slice(begin, end - begin)
                chance = linear.logistic(factorise(x, bias, weights, vectors)[0])
                yield pa.RecordBatch.from_pydict({"doc_id": ids, "score": chance})

    return narrow.mapInArrow(run, tables.arrow_fields(narrow.select("doc_id"), "score double"))


def quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score(docs, train(docs, labels, params), params)
    return scored.select(
        "doc_id",
        tables.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"),
    )
