"""Memory of tasks over texts: what they get at once, whatever rows a partition has."""

import re
from contextlib import contextmanager

import pytest
from conftest import ODD
from helpers import prose
from tokenizers import Tokenizer

from martwright.llm import decontamination, jaccard_join, packing, substring_dedup, tables, toxicity, words

LARGEST = 6 * 1024**2
MODEL = {"weights": bytes(4 * (1 << 18)), "bias": bytes(8)}
DEDUP = substring_dedup.DedupParams(least_line_words=3)


@contextmanager
def limit(spark, value):
    """The session's own limit of a batch; None: not set."""
    before = spark.conf.get(tables.BATCH_LIMIT, None)
    try:
        spark.conf.unset(tables.BATCH_LIMIT)
        if value:
            spark.conf.set(tables.BATCH_LIMIT, value)
        yield
    finally:
        spark.conf.unset(tables.BATCH_LIMIT)
        if before:
            spark.conf.set(tables.BATCH_LIMIT, before)


OPERATORS = {
    "toxicity": lambda docs, _: toxicity.score(docs, MODEL),
    "sketches": lambda docs, _: jaccard_join.sketches(docs, jaccard_join.JoinParams()),
    "first_of_each": lambda docs, _: jaccard_join.first_of_each(docs),
    "units": lambda docs, _: substring_dedup.units(docs, DEDUP),
    "remove_repeats": lambda docs, _: substring_dedup.remove_repeats(docs, DEDUP),
    "find_leaks": lambda docs, items: decontamination.find_leaks(docs, items),
    "pieces": lambda docs, _: packing.tokenized_pieces(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_task_gets_a_few_megabytes_of_text_at_once(spark, monkeypatch, name):
    text = "array_join(transform(sequence(1, 2000), i -> hex(xxhash64(id, i))), ' ')"
    docs = spark.range(0, 600, 1, 1).selectExpr("id as doc_id", f"{text} as text")
    items = spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string")
    blocks = words.blocks

    def bounded(batch, name="text"):
        assert batch.get_total_buffer_size() <= LARGEST, f"{batch.get_total_buffer_size()} bytes at once"
        return blocks(batch, name)

    monkeypatch.setattr(words, "blocks", bounded)
    with limit(spark, None):
        found = OPERATORS[name](docs, items)
        assert found.count() > 0


def results(spark):
    docs = spark.createDataFrame([*ODD, *((100 + i, prose(i % 7, 400)) for i in range(40))], "doc_id long, text string")
    items = spark.createDataFrame([(1, prose(3, 60))], "item_id long, text string")
    out = {name: run(docs.coalesce(1), items) for name, run in OPERATORS.items()}
    # The cosine follows the order in which blocks are summed; what is found doesn't.
    text = lambda row: re.sub(r"cosine=[^,]*", "", str(row))
    return {name: sorted(map(text, df.collect())) for name, df in out.items()}


def test_results_do_not_depend_on_the_size_of_a_batch(spark):
    with limit(spark, "64m"):
        large = results(spark)
    with limit(spark, "2k"):
        small = results(spark)
    for name, rows in large.items():
        assert small[name] == rows, name


def test_a_limit_of_the_session_stays(spark):
    with limit(spark, "1m"):
        toxicity.score(spark.createDataFrame([(1, "a")], "doc_id long, text string"), MODEL)
        assert spark.conf.get(tables.BATCH_LIMIT) == "1m"


def test_the_slow_tokenizer_is_loaded_only_for_special_tokens(monkeypatch):
    loaded, load = [], Tokenizer.from_file

    class Counted:
        @staticmethod
        def from_file(path):
            loaded.append(path)
            return load(path)

    monkeypatch.setattr(packing, "Tokenizer", Counted)
    encode = packing.encoder(packing.PackParams())
    plain = encode("a plain text")
    assert len(plain) and not loaded
    assert all(len(encode(f"{t} {packing.PackParams().special} b")) for t in "ac")
    assert len(loaded) == 1
