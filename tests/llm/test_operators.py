"""The operators against plain versions, and on odd input."""

import math
import random
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from conftest import SMALL
from helpers import WORD, jaccard_classes, prose
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from martwright.llm import catalog, components, decontamination, jaccard_join, license_scan, packing
from martwright.llm import quality_classifier, quality_rules, substring_dedup, tables, token_counts, toxicity, url_filter

LARGER = "/root/testdata/sf0.01"


def documents(spark, sf_dir):
    return tables.read(spark, sf_dir, "documents")


def test_registry():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names


def plain_units(text, params):
    data = np.frombuffer(text.encode(), np.uint8)
    found, _, cuts = substring_dedup.cut_units(data, np.array([0, len(data)]), params)
    raw = text.encode()
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        ws = tuple(raw[found.starts[i] : found.ends[i]].lower() for i in range(a, b))
        yield ws, n, len(raw[: found.starts[a]].decode()), len(raw[: found.ends[b - 1]].decode())


def plain_spans(texts, params):
    first, out = {}, set()
    for doc in sorted(texts):
        run = None
        for ws, n, begin, end in [*plain_units(texts[doc], params), (None, None, 0, 0)]:
            if ws in first and run and run[-1] == n - 1:
                run = [*run[:2], end, run[3] + len(ws), *run[4:6], n]
                continue
            if run and run[3] >= params.least_words:
                out.add(tuple(run[:6]))
            run = [doc, begin, end, len(ws), *first[ws], n] if ws in first else None
            if ws:
                first.setdefault(ws, (doc, begin))
    return out


@pytest.mark.parametrize("places, group_bytes", [(16, 8 * 1024**2), (1, 8 * 1024**2), (1, 1), (2, 1)])
def test_substring_dedup_equals_plain_version(spark, monkeypatch, places, group_bytes):
    """Whichever places are grouped by digest, and with all rows given twice."""
    monkeypatch.setattr(substring_dedup, "PLACES", places)
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", group_bytes)
    docs = documents(spark, LARGER)
    got = substring_dedup.removed_spans(docs.unionByName(docs)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(set(got))
    assert {(r.doc_id, r.begin, r.end, r.n_words, r.kept_doc_id, r.kept_begin) for r in got} == plain_spans(
        texts, substring_dedup.DedupParams()
    )


def test_passage_inside_lines_is_cut_and_clean_text_stays(spark):
    passage = prose(1, 60)
    rows = [(i, f"{prose(10 + i, 40)} {passage} {prose(50 + i, 40)}") for i in range(3)] + [(9, prose(99, 80))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert cut[0] == rows[0][1] and cut[9] == rows[3][1]
    for i in (1, 2):
        left = len(set(passage.split()) & set(cut[i].split()))
        assert left <= 24 and prose(50 + i, 40)[-60:] in cut[i]


def unpunctuated(seed, size, alphabet):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(size))


def test_passages_of_50_words_without_sentence_ends_are_cut_in_all_scripts(spark):
    rows, kept = [], {}
    for a, alphabet in enumerate(("etaoinshrdlu", "enisratäöüßdh", "esaitnruloéèç", "eaosrnidñóíl", "оеаинтсрвл")):
        for n in range(20):
            key = 1000 * a + 10 * n
            passage = unpunctuated(key, 50, alphabet)
            for i in (0, 1):
                made = [unpunctuated(90_000 + key + 3 * i, 30, alphabet), passage, unpunctuated(95_000 + key + 3 * i, 30, alphabet)]
                rows.append((key + i, " ".join(made)))
            kept[key + 1] = made[0], passage, made[2]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    for key, (before, passage, after) in kept.items():
        assert cut[key].startswith(before) and cut[key].endswith(after)
        assert len(cut[key].split()) <= 60 + 50 - 20
        # All places where 20 words of the passage stand in both documents, by comparing them.
        runs = {tuple(passage.split()[i : i + 31]) for i in range(20)}
        left = cut[key].split()
        assert not any(tuple(left[i : i + 31]) in runs for i in range(len(left)))
    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    cuts = substring_dedup.cut_units(data, np.array([0, len(data)]), substring_dedup.DedupParams())[2]
    assert np.diff(cuts).max() <= 16


def test_repeated_short_lines_are_removed(spark):
    params = substring_dedup.DedupParams(least_line_words=3)
    short, whole = "Read more about this here.", prose(7, 40)
    texts = [f"{prose(i, 12)}\n{short}\n{prose(50 + i, 9)}\nMore here\n{short}" for i in range(40)]
    texts += [f"{prose(90, 5)}\n{whole}\n{short}", f"{prose(91, 5)}\n{whole}\n{short}\nsays: {short}"]
    docs = spark.createDataFrame([*enumerate(texts), (None, short)], "doc_id long, text string")
    seen, expected = set(), {}
    for i, text in [*enumerate(texts), (None, short)]:
        lines = text.split("\n")
        keep = [x if len(x.split()) < 3 or x not in seen and not lines[:n].count(x) else "" for n, x in enumerate(lines)]
        seen |= set(lines)
        expected[i] = [x.rstrip(".") for x in keep if x]
    for i, r in {r.doc_id: r for r in substring_dedup.remove_repeats(docs, params).collect()}.items():
        assert [x.strip().rstrip(".") for x in r.text.split("\n") if x.strip(" .\n")] == expected[i]
    spans = sorted((str(r.doc_id), r.begin, r.end) for r in substring_dedup.removed_spans(docs, params).collect())
    assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:]))


def test_substring_dedup_of_odd_rows(spark, odd):
    out = substring_dedup.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert substring_dedup.removed_spans(odd.limit(0)).count() == 0


def test_texts_without_an_id_are_told_apart_by_more_than_their_print(spark, monkeypatch):
    """With prints that are all equal, documents without an id are still documents of their own."""
    monkeypatch.setattr(substring_dedup, "prints", lambda data, places: np.zeros(len(places) - 1, np.int64))
    repeated = prose(5, 40)
    rows = [(None, f"{prose(6, 200)}\n{repeated}"), (None, prose(7, 12)), (None, repeated), (None, prose(8, 300)), (1, repeated)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = substring_dedup.remove_repeats(docs).collect()
    assert sorted(r.text.strip() for r in left) == sorted([prose(6, 200), prose(7, 12), "", prose(8, 300), repeated])


def near(text, seed, changes):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_jaccard_join_equals_plain_version(spark):
    base = [prose(i, 150) for i in range(12)]
    rows = [(100 * i + k, near(t, 100 * i + k, k % 4)) for i, t in enumerate(base) for k in range(12)]
    rows += [(None, base[0]), (5000, None), (5001, ""), (3, base[3]), (3, base[3]), (6000, "a b"), (6001, "a  b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs).collect())
    expected = jaccard_classes(rows)
    for doc, count in ((5000, 1), (5001, 1)):
        assert got[(doc, doc, 0)] == count
    assert got == expected


def test_jaccard_join_splits_large_buckets(spark):
    common = prose(5, 30)
    rows = [(i, f"{prose(1000 + i // 3, 60)} {common} w{i}") for i in range(240)]
    params = jaccard_join.JoinParams(bucket=16, bucket_block=40, block=7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs, params).collect())
    assert got == jaccard_classes(rows)


def test_jaccard_join_on_given_documents(spark):
    docs = documents(spark, SMALL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs).collect())
    assert got == jaccard_classes(rows)


def test_first_of_each(spark, odd):
    kept = jaccard_join.first_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["10", "11", "7", "8", "9", "None"]
    assert jaccard_join.jaccard_join(odd.limit(0)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 300), (300, 200), (7, 7)]
    found = components.components(tables.Workspace(spark), spark.createDataFrame(links, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert all(roots[i] == 0 for i in range(41)) and {roots[n] for n in (100, 200, 300)} == {100}


def test_license_scan(spark):
    texts = [f"{prose(i, 30)}\n{t}\n{prose(i + 50, 30)}" for i, t in enumerate(t for ts in license_scan.TEMPLATES.values() for t in ts)]
    rows = [*enumerate(texts), (99, prose(99, 60)), (None, None), (98, ""), (98, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = license_scan.license_scan(docs).collect()
    found = {r.doc_id: r for r in got if r.confirmed}
    families = [f for f, ts in license_scan.TEMPLATES.items() for _ in ts]
    assert sum(found[i].family == f for i, f in enumerate(families) if i in found) >= 0.9 * len(families)
    for i, r in found.items():
        assert r.paragraph == 1 and texts[i][r.begin : r.end] == texts[i].split("\n")[1]
    assert license_scan.license_scan(docs.limit(0)).count() == 0


def test_wrapped_license_notices_are_found_whole(spark):
    rows, families = [], {}
    for family, templates in license_scan.TEMPLATES.items():
        for t in (t for t in templates if len(t.split()) >= 18):
            for width in (6, 11):
                made = t.split()
                lines = [" ".join(["#", *made[i : i + width]]) for i in range(0, len(made), width)]
                families[len(rows)] = family, "\n".join(lines)
                rows.append((len(rows), f"{prose(len(rows), 40)}\n\n" + "\n".join(lines) + f"\n\n{prose(60 + len(rows), 40)}"))
    plain = [(100 + i, "\n".join(prose(300 + 9 * i + k, 8) for k in range(9))) for i in range(20)]
    docs = spark.createDataFrame(rows + plain, "doc_id long, text string")
    confirmed = {r.doc_id: r for r in license_scan.license_scan(docs).collect() if r.confirmed}
    assert set(confirmed) == set(families) and len(families) >= 6
    for i, (family, notice) in families.items():
        r = confirmed[i]
        assert r.family == family and r.paragraph == 2 and rows[i][1][r.begin : r.end] == notice


def accuracy(scored, labels, label):
    rows = scored.filter("held_out").join(labels, "doc_id").select(label, "predicted").collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_classifiers_on_the_held_out_fold(spark):
    docs, labels = documents(spark, LARGER), tables.read(spark, LARGER, "labels")
    assert accuracy(quality_classifier.quality(docs, labels), labels, "quality") >= 0.9
    assert accuracy(toxicity.toxicity(docs, labels), labels, "toxic") >= 0.9
    rules = quality_rules.quality_rules(docs, labels).withColumn("held_out", tables.held_out("doc_id"))
    assert accuracy(rules.selectExpr("*", "int(probability >= 0.5) predicted"), labels, "quality") >= 0.9


def test_classifiers_on_odd_rows(spark, odd, no_labels):
    for scored in (quality_classifier.quality(odd, no_labels), toxicity.toxicity(odd, no_labels)):
        rows = scored.collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    rows = quality_rules.quality_rules(odd, no_labels).collect()
    assert len(rows) == 7 and all(r.base_failed and not r.kept for r in rows)
    assert toxicity.score(odd, toxicity.train(odd, no_labels)).columns[: len(odd.columns)] == odd.columns
    assert toxicity.toxicity(odd.limit(0), no_labels).count() == 0


def test_toxic_sentence_is_located(spark):
    rows = [(i, prose(i, 45) + (" you utter blockhead." if i % 3 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    for r in toxicity.toxicity(docs, labels).collect():
        assert r.predicted == (r.doc_id % 3 == 0)
        if r.predicted:
            assert any("blockhead" in rows[r.doc_id][1][s.begin : s.end] for s in r.spans)


def test_factorisation_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    index, value = rng.permutation(50)[:9], rng.normal(size=9)
    weights, vectors = rng.normal(size=50), rng.normal(size=(50, 4))
    x = quality_classifier.linear.Sparse(index, value, np.array([0, 9]))
    logit, _ = quality_classifier.factorise(x, 0.5, weights, vectors)
    pairs = sum(
        vectors[index[i]] @ vectors[index[j]] * value[i] * value[j] for i in range(9) for j in range(i)
    )
    assert logit[0] == pytest.approx(0.5 + weights[index] @ value + pairs)


def test_base_rules_equal_plain_version(spark, no_labels):
    docs = documents(spark, SMALL)
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs, no_labels).collect()}
    for r in docs.collect():
        words = WORD.findall(r.text)
        windows = list(zip(words, words[1:], words[2:]))
        count = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
        lines = [line for line in r.text.split("\n") if WORD.search(line)]
        mine = got[r.doc_id]
        assert (mine.n_words, mine.word_chars) == (len(words), sum(map(len, words)))
        assert mine.n_symbols == len(regex.findall(r"[#*$%&|<>]", r.text))
        assert (mine.n_dup_lines, mine.n_repeat_words) == (len(lines) - len(set(lines)), len(repeated))
        assert mine.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def test_packing_round_trip(spark):
    docs = documents(spark, SMALL)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack_documents(docs, packing.PackParams(pieces_per_task=60)).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for r in docs.collect():
        ids = [*whole.encode(r.text, add_special_tokens=False).ids, 0]
        parts = sorted(pieces[r.doc_id], key=lambda p: p.piece)
        assert [p.piece for p in parts] == list(range(len(parts))) and sum(p.length for p in parts) == len(ids)
        assert len(ids) <= 2048 and len(parts) == 1 or all(p.length == 2048 for p in parts[1:])
        for p in parts:
            own = np.array(ids[p.start : p.start + p.length], "<u4")
            assert zlib.crc32(own.tobytes()) == p.ids_crc32
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    least = packing.least_bins(np.array([r.length for r in rows]), 2048)
    assert least <= len(bins) <= 1.03 * least + 1


def test_bounds_and_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = rng.integers(1, 101, 60)
        bins, offsets, count = packing.best_fit_decreasing(lengths, 100)
        assert np.bincount(bins, lengths, count).max() <= 100
        assert -(-lengths.sum() // 100) <= packing.least_bins(lengths, 100) <= count
    assert packing.least_bins(np.array([60, 60, 60]), 100) == 3
    assert packing.least_bins(np.array([34] * 6), 100) == 3


def test_packing_of_odd_rows(spark, odd):
    rows = packing.pack_documents(odd).collect()
    assert sorted(str(r.doc_id) for r in rows if r.piece == 0) == ["10", "10", "11", "7", "8", "9", "None"]
    assert all(r.length == 1 for r in rows if r.doc_id in (7, 8))
    special = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    assert packing.pack_documents(special).first().length == 5


def test_decontamination(spark):
    items = [(i, f"{prose(i, 30)} {prose(200 + i, 8)}") for i in range(30)]
    benchmark = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    rows = [(i, prose(500 + i, 200)) for i in range(120)]
    words = items[3][1].split()
    rows += [(1000, f"{prose(700, 300)} {items[1][1]} {prose(701, 50)}"), (1001, items[2][1].upper())]
    rows += [(1002, f"{prose(702, 90)} {' '.join(w for i, w in enumerate(words) if i % 8 != 3)} {prose(703, 90)}")]
    rows += [(None, items[4][1]), (1003, None), (1003, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {(1000, 1), (1001, 2), (1002, 3), (None, 4)}
    found = decontamination.decontaminate(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    several = decontamination.decontaminate(docs, benchmark, decontamination.LeakParams(items=8)).collect()
    assert {(r.doc_id, r.item_id) for r in several} == expected
    assert decontamination.decontaminate(docs.limit(0), benchmark).count() == 0
    assert decontamination.decontaminate(docs, benchmark.limit(0)).count() == 0


def test_decontamination_finds_every_item_of_the_given_tables(spark, odd):
    docs, benchmark = documents(spark, LARGER), tables.read(spark, LARGER, "benchmark")
    texts, items = docs.collect(), benchmark.collect()
    whole = {(d.doc_id, i.item_id) for d in texts for i in items if i.text in d.text}
    found = {(r.doc_id, r.item_id) for r in decontamination.decontaminate(docs, benchmark).collect()}
    assert whole <= found and len(found - whole) <= 2
    kept = decontamination.find_leaks(odd, benchmark)
    assert kept.columns[:-1] == odd.columns and kept.count() == odd.count()


def rarely_replaced(text, share, seed):
    """The text with a share of its words replaced by words that occur nowhere else."""
    rng, made = random.Random(seed), text.split()
    for n, i in enumerate(rng.sample(range(len(made)), int(share * len(made)))):
        made[i] = f"zq{seed}x{n}"
    return " ".join(made)


def plain_leaks(texts, items, params):
    """``(text, item)`` where a window of the text, with as many words around it as the item has, holds it."""
    def split(text):
        return regex.findall(r"[a-z0-9]+", text.lower())

    out = set()
    for i, item in items:
        size, answer = len(split(item)), split([x for x in item.split(".") if split(x)][-1])
        whole, last = decontamination._bits(split(item)), decontamination._bits(answer)
        length = 1 << size.bit_length() - 1
        for d, text in texts:
            made = split(text)
            left = max(0, len(made) - length)
            for begin in [*range(0, left, max(1, length // 4)), left]:
                region = made[max(0, begin - size) : begin + length + size]
                overlap = decontamination.common_subsequence(whole, size, region) / size
                own = decontamination.common_subsequence(last, len(answer), region) / len(answer)
                if overlap >= params.overlap or overlap >= params.overlap_with_answer and own >= params.answer:
                    out.add((d, i))
                    break
    return out


def leaks_in_long_documents(spark, shares, params):
    """What is found, and by comparing all windows, in long documents with items, words of them replaced."""
    items = [(i, f"{prose(i, 30)} {prose(900 + i, 8)}") for i in range(120)]
    texts = []
    for d in range(5):
        parts = [prose(4000 + d, 80)]
        for n in range(12):
            text = rarely_replaced(items[12 * d + n][1], shares[n % len(shares)], 100 * d + n)
            # Words of the item out of order stand elsewhere in the document, twice.
            loose = random.Random(n).sample(text.split(), 18)
            parts += [" ".join(loose + loose), prose(5000 + 20 * d + n, 70), text, prose(6000 + 20 * d + n, 70)]
        texts.append((d, " ".join(parts)))
    rows = texts + [(1000 + i, prose(7000 + i, 60)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.decontaminate(docs, benchmark, params).collect()
    assert len({(r.doc_id, r.item_id) for r in found}) == len(found)
    return {(r.doc_id, r.item_id) for r in found if r.doc_id < 1000}, plain_leaks(texts, items, params)


def test_decontamination_checks_all_windows_of_long_documents(spark):
    found, expected = leaks_in_long_documents(spark, (0,), decontamination.LeakParams(rank=32))
    assert found == expected and {(n // 12, n) for n in range(60)} <= found


def test_decontamination_finds_items_with_rare_words_in_them(spark):
    found, expected = leaks_in_long_documents(spark, (0.1, 0.15, 0.2), decontamination.LeakParams())
    assert found == expected and {(n // 12, n) for n in range(60)} <= found


def test_least_share_is_the_least_of_all_choices():
    params, rng = decontamination.LeakParams(least_words=3), np.random.default_rng(5)
    for _ in range(20):
        gain, answer = rng.random(9), int(rng.integers(1, 9))
        sums = []
        for chosen in range(1 << 9):
            taken = np.array([chosen >> i & 1 for i in range(9)], bool)
            share, own = taken.mean(), taken[9 - answer :].mean()
            if share >= params.overlap or share >= params.overlap_with_answer and own >= params.answer:
                sums.append(gain[taken].sum())
        assert np.isclose(decontamination.least_share(gain, answer, params), min(sums))


def test_space_is_made_from_the_lines_of_all_documents(spark):
    params = decontamination.LeakParams(bits=12)
    texts = [f"{prose(i, 12)}\n{prose(3000 + i, 7)}" for i in range(450)]
    docs = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string")
    idf = np.random.default_rng(1).random(1 << 12).astype("f4") + np.float32(0.1)
    terms = np.arange(0, 1 << 12, 3)
    plain = np.zeros((900, 1 << 12))
    for row, line in enumerate(x for t in texts for x in t.split("\n")):
        data = np.frombuffer(line.encode(), np.uint8)
        bucket = decontamination._buckets(data, np.array([0, len(data)]), 12)[2]
        np.add.at(plain[row], bucket, idf[bucket] / np.sqrt((idf[bucket] ** 2).sum()))
    shipped = tables.ship(spark, {"idf": idf.tobytes()})
    matrix = tables.Workspace(spark).store(decontamination.passages(docs, shipped, terms, params))
    basis = np.random.default_rng(2).normal(size=(len(terms), 5))
    got = decontamination._products(matrix, idf[terms], basis)
    assert np.allclose(got, plain[:, terms].T @ (plain[:, terms] @ basis), atol=1e-3)
    # The vectors hold nearly as much of the passages as the best ones would.
    found = decontamination.singular_vectors(matrix, idf[terms], params)
    best = np.linalg.svd(plain[:, terms], compute_uv=False)[: params.rank]
    assert np.allclose(found.T @ found, np.eye(params.rank), atol=1e-6)
    held, chance = (((plain[:, terms] @ v) ** 2).sum() / (best**2).sum() for v in (found, np.linalg.qr(np.random.default_rng(4).normal(size=found.shape))[0]))
    assert held > 0.85 > 2 * chance
    items = np.random.default_rng(3).random((len(terms), 4))
    space = decontamination.latent_space(matrix, idf[terms], items, params)
    assert space.shape[1] == params.rank + 4 and np.allclose(space @ (space.T @ items), items, atol=1e-3)


def test_arrays_are_summed_in_levels(spark, monkeypatch):
    def arrays(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([0, 1], pa.int32()),
                        "values": [np.full(4, i, "i4").tobytes(), np.full(2, 2 * i, "i4").tobytes()],
                    }
                )

    monkeypatch.setattr(decontamination, "_LANE", 3)
    rows = spark.range(0, 50, 1, 50).mapInArrow(arrays, "part int, values binary")
    assert decontamination._sum_parts(rows, "i4").tolist() == [1225] * 4 + [2450] * 2
    assert not len(decontamination._sum_parts(rows.limit(0), "i4"))


def test_rows_are_added_where_they_belong():
    rng = np.random.default_rng(6)
    rows = rng.integers(0, 9, (50, 3)).astype("f4")
    for size, segments in ((0, 5), (1, 5), (40, 400), (900, 300), (900, 20), (900, 1)):
        at, of = np.sort(rng.integers(0, segments, size)), rng.integers(0, 50, size)
        at[: size // 3] = at[:1]  # one long segment
        total, expected = np.ones((segments, 3)), np.ones((segments, 3))
        np.add.at(expected, at, rows[of])
        decontamination._add_rows(total, at, rows, of)
        assert (total == expected).all()


@pytest.mark.parametrize("dense", [1, 64, 10**6])
def test_products_do_not_depend_on_how_many_terms_are_dense(spark, monkeypatch, dense):
    params, rng = decontamination.LeakParams(bits=10), np.random.default_rng(7)
    texts = [f"{prose(i, 200)}\n{'word ' * 60}\n\n{prose(i % 3, 5)}" for i in range(40)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    terms, idf = np.arange(0, 1 << 10, 2), rng.random(1 << 10).astype("f4") + np.float32(0.1)
    plain = np.zeros((160, 1 << 10))
    for row, line in enumerate(x for t in texts for x in t.split("\n")):
        data = np.frombuffer(line.encode(), np.uint8)
        bucket = decontamination._buckets(data, np.array([0, len(data)]), 10)[2]
        np.add.at(plain[row], bucket, idf[bucket] / np.sqrt((idf[bucket] ** 2).sum()))
    basis = rng.normal(size=(len(terms), 5))
    monkeypatch.setattr(decontamination, "_DENSE", dense)
    matrix = decontamination.passages(docs, tables.ship(spark, {"idf": idf.tobytes()}), terms, params)
    got = decontamination._products(matrix, idf[terms], basis)
    assert np.allclose(got, plain[:, terms].T @ (plain[:, terms] @ basis), atol=1e-3)


def searcher(items, more=0):
    """Of these items, in a space of as many more dimensions, completed by the items."""
    params, raw = decontamination.LeakParams(), [x.encode() for x in items]
    data = np.frombuffer(b"".join(raw), np.uint8)
    places = np.cumsum([0, *map(len, raw)])
    found, _, bucket = decontamination._buckets(data, places, params.bits)
    terms, idf = np.unique(bucket), np.ones(1 << params.bits, "f4")
    index = np.searchsorted(terms, np.arange(1 << params.bits))
    vectors = decontamination.item_vectors(index, idf, bucket, found.first, len(terms))
    random_ = np.random.default_rng(more).normal(size=(len(terms), more))
    space = np.linalg.qr(np.hstack([random_, vectors]))[0].astype("f4")
    model = {"terms": terms, "space": space, "texts": data, "sizes": np.diff(places), "idf": idf}
    return decontamination.Searcher({k: v.tobytes() for k, v in model.items()}, params)


def test_windows_are_made_only_where_an_item_may_be(monkeypatch):
    """A long text has the words of all items in many places, and few of them whole."""
    items = [f"{prose(i, 30)} {prose(900 + i, 8)}" for i in range(20)]
    rng, parts = random.Random(8), []
    for n in range(200):
        parts += [prose(5000 + n, 150), *rng.sample(items[n % 20].split(), 4)]
    parts[300:300] = [items[3]]
    text = " ".join(parts)
    search, made, compared = searcher(items), [], []
    stretch, overlaps = search._stretch, search._overlaps
    monkeypatch.setattr(search, "_stretch", lambda *a: made.append(len(a[0])) or stretch(*a))
    monkeypatch.setattr(search, "_overlaps", lambda item, low, *a: compared.append(len(low)) or overlaps(item, low, *a))
    data = np.frombuffer(text.encode(), np.uint8)
    found = search.search(data, np.array([0, len(data)]))
    assert [x["item"] for x in found[0]] == [3]
    everywhere = 20 * len(text.split()) // 8
    assert 0 < sum(made) < 0.1 * everywhere and sum(compared) < 100


def test_places_do_not_depend_on_the_singular_vectors():
    """Of windows that have as much of an item the one that has most within itself is reported."""
    items = [f"{prose(i, 30)} {prose(900 + i, 8)}" for i in range(12)]
    texts = [f"{prose(40 + i, 90 + i)} {item} {prose(80 + i, 90)}".encode() for i, item in enumerate(items)]
    data, places, found = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), []
    for more in (0, 3, 40, 41):
        leaks = searcher(items, more).search(data, places)
        found.append([[{k: v for k, v in x.items() if k != "cosine"} for x in text] for text in leaks])
    assert [[x["item"] for x in text] for text in found[0]] == [[i] for i in range(12)]
    assert all(other == found[0] for other in found)


def test_items_are_found_wherever_pieces_of_a_text_end():
    """The same as by comparing all windows, with the item at each place around the ends of pieces."""
    items = [f"{prose(i, 30)} {prose(900 + i, 8)}" for i in range(3)]
    search = searcher(items)
    around = prose(77, 3 * search.piece).split()
    texts = []
    for place in [*range(search.piece - 60, search.piece + search.reach + 60, 7), len(around) - 1, len(around), 0]:
        kept = rarely_replaced(items[place % 3], 0.1 * (place % 5 % 3), place)
        texts.append(" ".join([*around[:place], kept, *around[place : place + (place % 4) * search.reach]]))
    expected = plain_leaks([*enumerate(texts)], [*enumerate(items)], search.params)
    for together in (texts, texts[::-1]):
        raw = [t.encode() for t in together]
        found = search.search(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        got = {(together[i], x["item"]) for i, leaks in enumerate(found) for x in leaks}
        assert got == {(texts[i], item) for i, item in expected} and len(got) == len(texts)


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(decontamination._bits(a), len(a), b) == table[-1][-1]


def plain_count(word, scores):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        best.append(max(
            (best[b][0] + scores[word[b:end]], -1 + best[b][1]) for b in range(end) if word[b:end] in scores
        ))
    return -best[-1][1]


def test_token_counts_equal_plain_version(spark, odd):
    scores = token_counts.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = documents(spark, SMALL)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, scores, public_tokenizers.PATTERN).collect()}
    for r in docs.limit(60).collect():
        cut = regex.findall(public_tokenizers.PATTERN, r.text)
        assert got[r.doc_id].n_pre_tokens == len(cut)
        assert got[r.doc_id].n_tokens == sum(plain_count(w.encode(), scores) for w in cut)
    rows = token_counts.count_tokens(odd, scores, public_tokenizers.PATTERN).collect()
    assert len(rows) == 7 and all(r.n_tokens == 0 for r in rows if r.doc_id in (7, 8))
    assert math.isclose(sum(math.exp(s) for s in scores.values()), 1)


URLS = [
    (1, None), (2, "nourl"), (None, "http://A.ORG/"), (3, "x://a.org/"), (4, "x://a.org?q://"), (7, ""),
    (5, "x://www.example.org/es/1#a"), (5, "x://www.example.org/es/1#a"), (6, "http://spam-farm.example.com/en/5"),
    (8, "a://b.Com/fr/x?y"), (9, "a://éxample.org/en/12"), (10, "a://example.org/en/12"), (11, "a://badexample.org/en/12"),
]


def test_url_filter_equals_sql(spark):
    pages = spark.createDataFrame([(*u, "x") for u in URLS], "page_id long, url string, place string")
    duck = compare.connect(SMALL)
    duck.execute("DROP VIEW pages")
    duck.register("pages", pages.toPandas())
    got = compare.spark_result(url_filter.judge_urls(pages, url_filter.default_rules()))
    assert got == compare.oracle_result(duck, url_filter.oracle_sql())
    assert url_filter.judge_urls(pages.limit(0), url_filter.default_rules()).count() == 0


def test_url_query_equals_its_oracle(spark):
    got = compare.spark_result(catalog.registry()["op8_url_filters"](spark, LARGER))
    assert got == compare.oracle_result(compare.connect(LARGER), catalog.oracle()["op8_url_filters"])


def test_pipeline(spark):
    docs = documents(spark, SMALL)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs.count(), tables.Workspace(spark).store(stage(spark, docs, SMALL))
        if name != "best-fit packing":
            assert docs.columns == columns and 0.7 * before <= docs.count() <= before
    assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in documents(spark, SMALL).collect()}


def test_pipeline_without_documents(spark):
    docs = documents(spark, SMALL).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = tables.Workspace(spark).store(stage(spark, docs, SMALL))
    assert docs.count() == 0
