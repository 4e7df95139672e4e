"""Token counts under a unigram model, by dynamic programming shared along a trie.

A text is cut into pre-tokens, and each is segmented into the pieces whose scores add up to the
most. The best score and piece count of a prefix depend on the prefix alone, so the distinct
pre-tokens of a batch are walked in byte order, which is the depth-first order of their trie: what
was computed for the prefix shared with the word before stays, and every node is computed once.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martwright.llm import tables, words

#: Distinct pre-tokens whose counts a task keeps before it starts anew.
KEPT = 1_000_000


def vocabulary(path: str) -> dict[bytes, float]:
    """Pieces of a rank file with their scores.

    A rank file has no probabilities; the score of a piece is the logarithm of its share under
    Zipf's law, by its rank. All single bytes are pieces, so everything can be segmented.
    """
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


def trie_counts(pre_tokens: list[bytes], scores: dict[bytes, float]) -> dict[bytes, int]:
    """Pieces in the best segmentation of each pre-token; of equal scores, the fewest pieces."""
    longest = max(map(len, scores))
    best, pieces, counts, last = [0.0], [0], {}, b""
    for word in sorted(pre_tokens):
        shared, most = 0, min(len(word), len(last))
        while shared < most and word[shared] == last[shared]:
            shared += 1
        del best[shared + 1 :], pieces[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            top, fewest = -math.inf, 0
            for begin in range(max(0, end - longest), end):
                score = scores.get(word[begin:end])
                if score is not None:
                    score += best[begin]
                    if score > top or score == top and pieces[begin] < fewest:
                        top, fewest = score, pieces[begin]
            best.append(top)
            pieces.append(fewest + 1)
        counts[word] = pieces[-1]
        last = word
    return counts


def count_tokens(docs: DataFrame, scores: dict[bytes, float], pattern: str) -> DataFrame:
    """``doc_id, n_pre_tokens, n_tokens`` of every row; NULL and empty texts have none of either.

    Each task has a trie of its own, which holds one path at a time, and keeps the counts of at
    most ``KEPT`` pre-tokens; so nothing is shuffled and memory is bounded. Repeated rows stay.
    """
    size = sum(map(len, scores)) + 8 * len(scores)
    if size > tables.LARGEST_MODEL:
        raise ValueError(f"a vocabulary of {size} bytes is too large to send to every executor")
    shipped = docs.sparkSession.sparkContext.broadcast(scores)
    narrow = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, find, known = shipped.value, regex.compile(pattern).findall, {}
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for begin, end, data, places in words.blocks(batch):
                raw = data.tobytes()
                cut = [find(raw[a:b].decode()) for a, b in zip(places, places[1:])]
                new = set(chain.from_iterable(cut))
                if len(known) + len(new) > KEPT:
                    known = {}
                missing = [w.encode() for w in new if w not in known]
                known |= {w.decode(): n for w, n in trie_counts(missing, scores).items()}
                totals = [sum(map(known.__getitem__, c)) for c in cut]
                out = {"doc_id": ids.slice(begin, end - begin), "n_pre_tokens": list(map(len, cut)), "n_tokens": totals}
                yield pa.RecordBatch.from_pydict(out)

    return narrow.mapInArrow(run, tables.arrow_fields(narrow.select("doc_id"), "n_pre_tokens long, n_tokens long"))

