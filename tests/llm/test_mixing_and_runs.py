"""Source mixing, source divergence and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
from conftest import SMALL
from helpers import WORD
from pyspark.sql import functions as F

from martwright.llm import catalog, periodic_runs, source_divergence, source_mixing, tables


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", ["op11_source_mixing", "op12_source_divergence"])
def test_query_equals_its_oracle(spark, duck, name):
    found = compare.spark_result(catalog.registry()[name](spark, SMALL))
    assert found == compare.oracle_result(duck, catalog.oracle()[name])


# --- mixing ---------------------------------------------------------------------------------


def sources_of(spark, sizes: dict):
    """Documents of given sizes by source; every word says where it is from."""
    rows = [(i * 100 + j, " ".join(f"{s}-{j}-{k}" for k in range(n)), s) for i, (s, ns) in enumerate(sizes.items()) for j, n in enumerate(ns)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def plain_targets(sizes: dict[str | None, int], weights=(5, 2, 1), most=3) -> dict:
    """Round by round: whoever is above the limit is set to it, the rest is shared again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        left = [s for s in order if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = [s for s in left if share[s] > most * sizes[s]]
        if not above:
            return full | share
        full |= {s: most * sizes[s] for s in above}


def test_targets_stop_at_three_times_a_source(spark):
    for sizes in ({"a": 10, "b": 4000, "c": 1, None: 900}, {"a": 0, "b": 7}, {"x": 5}, {"é": 100, "z": 1, "a": 100_000, "b": 3, None: 3}):
        work = tables.Workspace(spark)
        rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        found = source_mixing.targets(work, rows, source_mixing.MixParams()).collect()
        assert {r.source: pytest.approx(r.target) for r in found} == plain_targets(sizes)


SMALL_MIX = source_mixing.MixParams(block_words=40, shard_blocks=5, part_rows=7, depth=2)


def test_mix_takes_exactly_the_targets_and_deals_every_block_once(spark):
    rng = random.Random(3)
    sizes = {s: [rng.choice([1, 5, 30, 200]) for _ in range(n)] for s, n in (("a", 60), ("b", 12), ("c", 3), ("d", 25))}
    docs = sources_of(spark, sizes)
    found = source_mixing.mix(docs, SMALL_MIX)
    placed, draws = {r.row: r for r in found.placed.collect()}, found.draws.collect()
    target = plain_targets({s: sum(n) for s, n in sizes.items()})
    taken = Counter()
    for d in draws:
        taken[placed[d.row].source] += d.words
    assert taken == {s: int(t) for s, t in target.items()}
    assert len({(d.row, d["pass"]) for d in draws}) == len(draws)
    assert all(d.words <= placed[d.row]["size"] for d in draws) and max(d["pass"] for d in draws) <= 2
    # A block is in one shard; shards have the same number of blocks, and places without gaps.
    shards = defaultdict(set)
    for d in draws:
        shards[d["rank"], d.block].add(d.shard)
    assert all(len(s) == 1 for s in shards.values())
    places = defaultdict(list)
    for d in draws:
        places[d.shard].append(d.place)
    assert len(places) > 10 and all(sorted(p) == list(range(len(p))) for p in places.values())


def test_leaves_of_the_tree_add_up_and_don_t_overlap(spark):
    quotas = spark.createDataFrame([(1, 501), (2, 77), (5, 1), (9, 300)], "rank long, blocks long")
    dealt = source_mixing.deal_blocks(tables.Workspace(spark), quotas, SMALL_MIX).collect()
    blocks = defaultdict(list)
    for r in dealt:
        blocks[r["rank"]].append(r.block)
    assert {k: sorted(v) for k, v in blocks.items()} == {k: list(range(n)) for k, n in ((1, 501), (2, 77), (5, 1), (9, 300))}
    per_shard = Counter(r.shard for r in dealt)
    assert len(per_shard) == -(-879 // 5) and max(per_shard.values()) - min(per_shard.values()) <= 1
    # A shard's share of a source varies as drawing without putting back does.
    shares = np.array([sum(1 for r in dealt if r.shard == s and r["rank"] == 1) for s in per_shard])
    assert abs(shares.mean() - 501 / 176) < 0.1 and 0.5 < shares.var() < 2
    again = source_mixing.deal_blocks(tables.Workspace(spark), quotas.repartition(3), SMALL_MIX).collect()
    assert sorted(again) == sorted(dealt)


def test_permutation_is_one():
    for size in (1, 2, 3, 17, 64, 1000):
        image = source_mixing.permuted(np.arange(size), size, 5)
        assert sorted(image) == list(range(size))
    assert (source_mixing.permuted(np.arange(1000), 1000, 5) != source_mixing.permuted(np.arange(1000), 1000, 6)).any()


def test_mixed_documents_hold_the_words_of_the_draws(spark):
    docs = sources_of(spark, {"a": [9, 40, 3], "b": [200] * 4, None: [10, 0]}).withColumn("shard", F.lit("own"))
    rows = source_mixing.mixed_documents(docs, SMALL_MIX).collect()
    words = Counter()
    for r in rows:
        assert r.shard == "own" and len(WORD.findall(r.text)) == r.words
        words[r.source] += r.words
    assert words == {s: int(t) for s, t in plain_targets({"a": 52, "b": 800, None: 10}).items()}


def test_rerun_and_partitions_change_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one, other = (sorted(source_mixing.words_taken(d, SMALL_MIX).collect()) for d in (docs, docs.repartition(5)))
    assert one == other


def test_mixing_odd_rows(spark, odd):
    docs = odd.withColumn("source", F.when(F.col("doc_id") != 8, F.lit("s"))).withColumn("rank", F.lit(1))
    found = source_mixing.words_taken(docs).collect()
    assert len(found) == docs.count() and all(0 <= r.taken <= 3 * r["size"] for r in found)
    assert sum(r.taken for r in found) == sum(r["size"] for r in found)
    assert source_mixing.words_taken(docs.limit(0)).collect() == []
    assert source_mixing.mixed_documents(docs.limit(0)).collect() == []
    nothing = docs.withColumn("text", F.lit(None).cast("string"))
    assert {r.taken for r in source_mixing.words_taken(nothing).collect()} == {0}


# --- divergence -----------------------------------------------------------------------------


def plain_divergence(rows, least=3, top=200):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = "".join(c if c.isascii() and c.isalpha() or ord(c) > 127 else " " for c in raw).split(" ")
        terms = [t for t in terms if t]
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for (lang, source), own in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        total = {g: sum(c[t] for t in kept) for g, c in groups.items() if g[0] == lang}
        whole = sum(total.values())
        share = lambda n, size: 1 + 10**9 * (n + 1) // (size + len(kept))
        mine = {t: share(own[t], total[lang, source]) for t in kept}
        pairs, found = [], []
        for (other_lang, other), counts in groups.items():
            if other_lang == lang and other != source:
                theirs = {t: share(counts[t], total[lang, other]) for t in kept}
                pairs.append((sum((mine[t] - theirs[t]) ** 2 // theirs[t] for t in kept), other))
        for t in kept:
            q = share(sum(c[t] for g, c in groups.items() if g[0] == lang), whole)
            if own[t] and mine[t] > q:
                found.append(((mine[t] - q) ** 2 // q, t))
        for part, values in (("pair", pairs), ("term", found)):
            ranked = sorted(values, key=lambda v: (-v[0], v[1].encode()))
            for rank, (value, item) in enumerate(ranked[: top if part == "term" else None], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


def prose_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)] + ["Ünder", "naïve", "Ǝ"]
    rows = []
    for i in range(160):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])
        bias = {"a": 40, "b": 200, "c": 400, None: 20}[source]
        words = [vocabulary[min(int(rng.expovariate(1) * bias / 4), len(vocabulary) - 1)] for _ in range(rng.randint(0, 120))]
        rows.append((lang, source, rng.choice([" ", ", ", "1"]).join(words)))
    return rows + [("xx", "only", "alone here"), ("yy", "p", "rare"), ("yy", "q", ""), ("yy", "r", None), ("en", "none", "1 2 3")]


@pytest.mark.parametrize("params", [{}, {"chunk_rows": 50, "held": 7}, {"least_docs": 1, "top": 3, "chunk_rows": 300}])
def test_divergence_equals_plain_version(spark, params):
    rows = prose_rows(4)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    found = source_divergence.source_divergence(docs.repartition(6), source_divergence.DivergenceParams(**params))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    plain = plain_divergence(rows, params.get("least_docs", 3), params.get("top", 200))
    assert sorted(map(tuple, found.collect())) == plain


def test_joint_cells_of_bitmaps_and_lists(spark):
    rng = np.random.default_rng(2)
    import pyarrow as pa

    counts = {s: np.where(rng.random(3000) < 0.6, rng.zipf(1.5, 3000).clip(0, 500), 0) for s in "ab"}
    rows = [(s, f"t{i}", int(n)) for s, c in counts.items() for i, n in enumerate(c) if n]
    chunk = pa.table({"lang": ["l"] * len(rows), "chunk": [0] * len(rows), "source": [r[0] for r in rows], "term": [r[1] for r in rows], "n": [r[2] for r in rows]})
    levels = source_divergence.make_levels(chunk).to_pylist()
    assert {r["dense"] for r in levels} == {True, False}
    a, b = (source_divergence.read_levels([r for r in levels if r["source"] == s], levels[0]["terms"]) for s in "ab")
    i, j, n = source_divergence.joint_cells(a, b)
    cells = {(int(a.counts[x]), int(b.counts[y])): int(z) for x, y, z in zip(i, j, n)}
    assert cells == Counter((int(x), int(y)) for x, y in zip(counts["a"], counts["b"]) if x and y)


def test_divergence_of_odd_rows(spark, odd):
    docs = odd.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.col("rank"))
    plain = plain_divergence([(None, "r", r.text) for r in odd.collect()])
    assert sorted(map(tuple, source_divergence.source_divergence(docs).collect())) == plain
    assert source_divergence.source_divergence(docs.limit(0)).collect() == []


# --- runs -----------------------------------------------------------------------------------


def plain_runs(words, least=12):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i >= max(p, least - p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def plain_digest(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    hashed = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{a},{b},{c}\n" for a, b, c in runs), kept)]
    return (doc_id, len(runs), *best, exponent, *hashed)


def test_runs_equal_plain_version():
    rng = random.Random(8)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, kinds = rng.randint(0, 150), rng.choice([1, 2, 2, 3, 5, 60])
            words = [rng.randrange(kinds) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, n // 2 + 1)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
                if rng.random() < 0.4:
                    words[rng.randrange(n)] = 99
            texts.append(words)
        ids = np.array(sum(texts, []), np.int64)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        text, *columns = periodic_runs.find_runs(ids, first, 12)
        for i, words in enumerate(texts):
            assert [tuple(map(int, r)) for r in zip(*(c[text == i] for c in columns))] == plain_runs(words)


def test_long_periods_and_fibonacci_words():
    a, b = "0", "01"
    while len(b) < 800:
        a, b = b, b + a
    texts = [list(b), [str(i % 333) for i in range(1000)], list("0" * 900), [str(i // 3 % 7) for i in range(500)]]
    for words in texts:
        _, ids = np.unique(words, return_inverse=True)
        found = periodic_runs.find_runs(ids.astype(np.int64), np.array([0, len(ids)]), 12)
        assert list(zip(*(c.tolist() for c in found[1:]))) == plain_runs(words)


def test_time_grows_with_the_words_only():
    """A million equal words, or blocks of them, would take hours if every repeat were compared."""
    for words in (np.zeros(10**6, np.int64), np.concatenate([np.append(np.zeros(60), 100 + i) for i in range(5000)]).astype(np.int64)):
        found = periodic_runs.find_runs(words, np.array([0, len(words)]), 12)
        assert len(found[0]) in (1, 5000)


def test_run_digests_equal_plain_version(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["a", "b", "ç", "d e"], k=rng.randint(0, 90)))) for i in range(400)]
    rows += [(None, "x\ty " * 20), (None, None), (7, "  \n"), (7, "one"), (7, "one"), (-3, "p q " * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.plant(docs)))
    assert Counter(map(tuple, found.collect())) == Counter(plain_digest(*r) for r in rows)


def test_run_query_equals_plain_version(spark):
    """On a digest of the given documents; texts too long for the plain version are left to the others."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = {r.doc_id: tuple(r) for r in catalog.op13_periodic_runs(spark, SMALL).collect()}
    assert set(found) == set(docs)
    for doc_id, text in docs.items():
        if len(text) < 4000:
            assert found[doc_id] == plain_digest(doc_id, text)


def test_runs_of_odd_rows(spark, odd):
    found = periodic_runs.periodic_runs(odd).collect()
    assert Counter(r.n_words for r in found) == Counter({7: 1, 0: 3, 1: 2, 30_000: 1})
    long = next(r for r in found if r.n_words == 30_000)
    assert [tuple(x) for x in long.runs] == [(0, 30_000, 1)] and long.collapsed == "word"
    word = spark.createDataFrame([(1, "x" * 3_000_000)], "doc_id long, text string")
    assert len(periodic_runs.periodic_runs(word).first().collapsed) == 3_000_000
    assert periodic_runs.digests(periodic_runs.periodic_runs(odd.limit(0))).collect() == []
