"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's chance is a logistic function of its hashed words and word beginnings; a document's is
the noisy-or of its sentences. Both are trained together from the labels of documents, and scoring
gives the sentences that made a document toxic, with their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import tables, words


@dataclass(frozen=True)
class ToxicityParams:
    """``sample`` bounds the labelled documents learned from; features seen in fewer than
    ``least_documents`` of them have no weight."""

    sample: int = 5000
    bits: int = 18
    beginnings: tuple[int, ...] = (4, 6, 8)
    least_documents: int = 4
    rounds: int = 80
    rate: float = 8.0
    bias_rate: float = 2.0
    penalty: float = 0.0003
    largest: float = 12.0
    threshold: float = 0.5
    sentence_threshold: float = 0.5


#: Bytes that end a sentence.
ENDS = b".!?\n"
_ENDS = np.isin(np.arange(256), np.frombuffer(ENDS, np.uint8))


def sentences(data: np.ndarray, found: words.Words) -> np.ndarray:
    """The first word of each sentence: of each text, and after a gap with an end of sentence."""
    if not len(found.starts):
        return np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(_ENDS[data])])
    opens = np.ones(len(found.starts), bool)
    opens[1:] = ends[found.starts[1:]] > ends[found.ends[:-1]]
    opens[found.first[:-1][found.first[:-1] < found.first[1:]]] = True
    return np.flatnonzero(opens)


def features(data: np.ndarray, found: words.Words, params: ToxicityParams) -> np.ndarray:
    """A row per word: buckets of the word and of its beginnings; bucket 0 has no weight."""
    hashed = words.hash_words(data, found, lower=True, prefixes=params.beginnings)
    span = np.uint64((1 << params.bits) - 1)
    kinds = [words.mix(h + np.uint64(k)) % span + np.uint64(1) for k, h in enumerate(hashed)]
    for kind, h in zip(kinds[1:], hashed[1:]):
        kind[h == 0] = 0
    return np.stack(kinds, axis=1).astype(np.int32)


def fit(batches: Iterator[pa.RecordBatch], params: ToxicityParams) -> dict[str, bytes]:
    """Weights of the buckets and the bias, by gradient steps on the noisy-or likelihood."""
    rows, sizes, of_text, labels, seen = [], [], [], [], np.zeros(1 << params.bits, np.int32)
    for batch in batches:
        label = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
        for begin, end, data, places in words.blocks(batch):
            found = words.find_words(data, places, words.ALNUM)
            buckets, opens = features(data, found, params), sentences(data, found)
            for i in range(end - begin):
                a, b = found.first[i], found.first[i + 1]
                seen[np.unique(buckets[a:b])] += 1
            of_text.append(found.text[opens] + len(labels))
            sizes.append(np.diff(np.append(opens, len(found.starts))) * buckets.shape[1])
            rows.append(buckets.ravel())
            labels.extend(label[begin:end])
    bias, weights = -5.0, np.zeros(1 << params.bits, np.float32)
    y = np.array(labels, np.float64)
    if 0 < y.sum() < len(y):
        used = seen >= params.least_documents
        used[0] = False
        flat, size, text = np.concatenate(rows), np.concatenate(sizes), np.concatenate(of_text)
        rows.clear()
        kept = used[flat]
        size = words.sums_by(kept, np.concatenate([[0], np.cumsum(size)])).astype(np.int64)
        flat, sentence = flat[kept], np.repeat(np.arange(len(size), dtype=np.int32), size)
        del kept
        bias, weights = _descend(flat, sentence, text, y, seen / len(y), params)
    return {"weights": weights.astype(np.float32).tobytes(), "bias": np.float64(bias).tobytes()}


def _descend(
    flat: np.ndarray,
    sentence: np.ndarray,
    text: np.ndarray,
    y: np.ndarray,
    share: np.ndarray,
    params: ToxicityParams,
) -> tuple[float, np.ndarray]:
    """Proximal gradient steps on an L1 penalty; ``share`` is that of documents with a feature.

    Weights aren't negative, so harmless words around an insult can't hide it. A frequent feature
    takes shorter steps, by the root of its document frequency, and one that occurs in few toxic
    documents stays below the penalty, so single mislabelled documents aren't learned by heart.
    """
    dims, n, docs = 1 << params.bits, len(text), len(y)
    step = params.rate / np.sqrt(np.maximum(share, 1 / docs))
    weights, bias = np.zeros(dims), -5.0
    for _ in range(params.rounds):
        logit = bias + np.bincount(sentence, weights[flat], n)
        chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        clean = np.exp(np.bincount(text, np.log1p(-np.minimum(chance, 1 - 1e-9)), docs))
        blame = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-3), 1.0)[text] * chance / docs
        grad = np.bincount(flat, blame[sentence], dims)
        weights = np.clip(weights - step * (grad + params.penalty), 0, params.largest)
        bias -= params.bias_rate * np.clip(blame.sum(), -0.3, 0.3)
    return float(bias), weights


def train(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> dict[str, bytes]:
    """A model of ``labels.toxic``, from at most ``params.sample`` documents outside the held-out fold.

    Without labelled documents of both kinds nothing is toxic.
    """
    sample = tables.labelled_sample(docs, labels, "toxic", params.sample)
    return tables.fit_in_one_task(sample, lambda batches: fit(batches, params))


def score(docs: DataFrame, model: dict[str, bytes], params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """All columns of ``docs`` and ``toxicity struct<score, spans>``.

    ``spans`` has the sentences whose own chance reaches ``sentence_threshold``, with the places of
    their first and after their last word in characters. NULL and texts without words score 0.
    Repeated rows stay, and each row is scored by its text alone.
    """
    shipped = tables.ship(docs.sparkSession, model)
    name = tables.unused("toxicity", docs)
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shipped.value["weights"], np.float32)
        bias = float(np.frombuffer(shipped.value["bias"], np.float64)[0])
        for batch in batches:
            out = []
            for _, _, data, places in words.blocks(batch):
                out += _scored(data, places, weights, bias, params)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*batch.schema.names, name])

    ddl = f"`{name}` struct<score: double, spans: array<struct<begin: bigint, end: bigint, score: double>>>"
    return tables.in_batches(docs, run, tables.arrow_fields(docs, ddl))


def _scored(data: np.ndarray, places: np.ndarray, weights: np.ndarray, bias: float, params: ToxicityParams) -> list:
    found = words.find_words(data, places, words.ALNUM)
    if not len(found.starts):
        return [{"score": 0.0, "spans": []} for _ in places[1:]]
    opens = sentences(data, found)
    by_word = weights[features(data, found, params)].sum(axis=1)
    logit = bias + words.sums_by(by_word, np.append(opens, len(by_word)))
    chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    first = np.searchsorted(opens, found.first)
    whole = 1 - np.exp(words.sums_by(np.log1p(-np.minimum(chance, 1 - 1e-9)), first))
    out = [{"score": s, "spans": []} for s in np.clip(whole, 0, 1).tolist()]
    begins, ends = found.starts[opens], found.ends[np.append(opens[1:], len(by_word)) - 1]
    for at in np.flatnonzero(chance >= params.sentence_threshold):
        text = int(np.searchsorted(first, at, "right")) - 1
        low = places[text]
        a = len(data[low : begins[at]].tobytes().decode())
        b = a + len(data[begins[at] : ends[at]].tobytes().decode())
        out[text]["spans"].append({"begin": a, "end": b, "score": float(chance[at])})
    return out


def toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` of every document."""
    narrow = docs.select("doc_id", "text")
    scored = score(narrow, train(narrow, labels, params), params)
    return scored.select(
        "doc_id",
        tables.held_out("doc_id").alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= params.threshold).cast("int").alias("predicted"),
        F.col("toxicity.spans").alias("spans"),
    )
