"""Best-fit packing of tokenized documents into sequences, with certified bin counts.

Pieces are dealt to partitions, and each packs its own by best-fit decreasing. Dual-feasible
functions give a lower bound of a partition's bins; where the count equals it, the packing is proved
optimal and stays. Partitions with a gap keep their full bins and give the pieces of the others into
the next round, where they are dealt anew to fewer partitions, until nothing is gained.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martwright.llm import tables, words


@dataclass(frozen=True)
class PackParams:
    """``pieces_per_task`` bounds the pieces that one task packs."""

    capacity: int = 2048
    end_id: int = 0
    vocabulary: str = "byte_bpe_50k"
    special: str = "<|endoftext|>"
    pieces_per_task: int = 50_000
    rounds: int = 4


PIECE = "piece int, start long, length long, ids_crc32 long"


def encoder(params: PackParams):
    """Text to ids, as ``tokenizers`` has them for the vocabulary.

    The rank file of the same vocabulary gives the same ids several times as fast; only a text with
    the name of a special token in it, which ``tokenizers`` takes for that token, goes there. Most
    tasks have none and don't load it.
    """
    with open(public_tokenizers.path(f"{params.vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if params.special in text:
            if not whole:
                whole.append(Tokenizer.from_file(public_tokenizers.path(f"{params.vocabulary}.json")))
            return np.array(whole[0].encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), "<u4")

    return encode


def tokenized_pieces(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document; NULL is an empty text.

    A document is its ids and the end id. Longer ones than a sequence are cut so that the first
    piece takes what is left over and all others fill a sequence.
    """
    narrow = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = encoder(params), params.capacity
        for batch in batches:
            for begin, end, data, places in words.blocks(batch):
                raw, rows = data.tobytes(), []
                for i in range(end - begin):
                    ids = np.append(encode(raw[places[i] : places[i + 1]].decode()), np.uint32(params.end_id))
                    first = len(ids) % size or size
                    cuts = [0, *range(first, len(ids) + 1, size)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((begin + i, piece, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes())))
                row, piece, start, length, crc = map(list, zip(*rows))
                ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(row))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                values = [pa.array(v, k) for v, k in zip((piece, start, length, crc), kinds)]
                yield pa.RecordBatch.from_arrays([ids, *values], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return tables.in_batches(narrow, run, tables.arrow_fields(narrow.select("doc_id"), PIECE))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins.

    Bins are kept by the room left in them; a set bit per amount of room gives the least that
    suffices in one step.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_no = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, bin_no = capacity, count
            count += 1
        bins[i], offsets[i] = bin_no, capacity - room
        left = room - length
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(bin_no)
    return bins, offsets, count


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """Lower bound of the bins, the best over two families of dual-feasible functions.

    One, for a threshold t, counts pieces above capacity - t as whole bins and drops those below t;
    the other rounds (k + 1) times a piece's share down to multiples of 1 / k unless it is whole.
    """
    if not len(lengths):
        return 0
    histogram = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    sizes = np.arange(capacity + 1)
    count, volume = np.cumsum(histogram), np.cumsum(histogram * sizes)
    best = -(-int(volume[-1]) // capacity)
    for t in range(1, capacity // 2 + 1):
        large = int(count[-1] - count[capacity - t])
        middle = int(volume[capacity - t] - volume[t - 1])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 21):
        share = (k + 1) * sizes
        rounded = np.where(share % capacity == 0, share * k, share // capacity * capacity * (k + 1))
        best = max(best, -(-int((histogram * rounded).sum()) // (capacity * k * (k + 1))))
    return best


def pack(pieces: DataFrame, work: tables.Workspace, params: PackParams = PackParams()) -> DataFrame:
    """Columns of ``pieces`` with ``sequence_id`` and ``offset``. No pieces give no sequences."""
    spark, kept = pieces.sparkSession, []
    waiting = work.store(pieces)
    for number in range(params.rounds):
        count = waiting.count()
        if not count:
            break
        parts = -(-count // params.pieces_per_task)
        last = number + 1 == params.rounds or parts == 1
        packed = work.store(_packed(waiting, number, parts, last, params))
        if number and not last:
            bins = packed.agg(F.countDistinct("sequence_id")).first()[0]
            last = bins >= open_bins
        # A packing that its bound certifies stays, and so do the full bins of the others.
        settled = packed.filter(F.lit(last) | F.col("settled"))
        kept.append(settled.drop("settled"))
        if last:
            break
        rest = packed.filter(~F.col("settled"))
        open_bins = rest.agg(F.countDistinct("sequence_id")).first()[0]
        waiting = rest.select(*pieces.columns)
    result = spark.createDataFrame([], tables.arrow_fields(pieces, "sequence_id long, offset long"))
    for part in kept:
        result = result.unionByName(part)
    return result


def _packed(pieces: DataFrame, number: int, parts: int, last: bool, params: PackParams) -> DataFrame:
    """One round. Pieces are dealt by a hash of what they hold, so each partition gets its share of
    every length, and a task that is run again gets the same ones."""
    key = F.pmod(F.xxhash64(F.lit(number), "doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(parts))
    dealt = pieces.withColumn("part", key.cast("int"))
    schema = tables.arrow_fields(pieces, "sequence_id long, offset long, settled boolean")

    def fill(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        group = group.drop_columns(["part"])
        group = group.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32")])
        lengths = group.column("length").to_numpy()
        bins, offsets, count = best_fit_decreasing(lengths, params.capacity)
        certified = count == least_bins(lengths, params.capacity)
        room = params.capacity - np.bincount(bins, lengths, count).astype(np.int64)
        settled = np.full(len(bins), True) if certified or last else room[bins] == 0
        base = (number << 56) | (part << 32)
        return (
            group.append_column("sequence_id", pa.array(bins + base, pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64()))
            .append_column("settled", pa.array(settled))
        )

    return dealt.groupBy("part").applyInArrow(fill, schema)


def pack_documents(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every row.

    A document without text is its end id alone. Repeated rows and NULL ids are packed like others.
    """
    work = tables.Workspace(docs.sparkSession)
    return pack(tokenized_pieces(docs, params), work, params)
