"""Wrapped licence notices against all ranges of lines."""

from __future__ import annotations

import resource
import types

import numpy as np
import pyarrow as pa
from conftest import LARGER, SMALL
from helpers import prose

from martwright.llm import license_scan as scan
from martwright.llm import words

PARAMS = scan.LicenseParams()
OWN = [scan.template_words(t) for ts in scan.TEMPLATES.values() for t in ts]


def all_windows(text: str) -> set[tuple[int, int]]:
    """Per first line and template, of all ranges of lines the one with most of it, the shortest of those."""
    lines = [scan.template_words(x) for x in text.split("\n")]
    out = set()
    for a in range(len(lines)):
        best = {}
        for b in range(a + 1, len(lines) + 1):
            if not lines[b - 1]:
                break
            own = [w for x in lines[a:b] for w in x]
            for k, t in enumerate(OWN):
                if b > a + 1 and len(own) <= PARAMS.spread * len(t) and (m := scan.match(own, t)) >= PARAMS.least_match - 1e-9:
                    if m > best.get(k, (0, 0))[0]:
                        best[k] = (m, b)
            if len(own) > PARAMS.spread * max(map(len, OWN)):
                break
        out |= {(a, b) for _, b in best.values()}
    return out


def found_windows(texts: list[str], rarity: dict) -> list[set[tuple[int, int]]]:
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    places = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    lines = scan.paragraphs(data, places)
    found, hashed = scan._hashed(data, lines)
    of = np.searchsorted(places, lines[:-1], "right") - 1
    out: list[set] = [set() for _ in texts]
    for a, b in scan.wrapped(found, hashed, of, scan.read_templates(rarity, PARAMS.least_match), PARAMS):
        first = np.searchsorted(lines, places[of[a]])
        out[of[a]].add((int(a - first), int(b - first)))
    return out


def wrap(template: str, width: int, mark: str) -> str:
    own = template.split()
    return "\n".join(" ".join([mark, *own[i : i + width]]).strip() for i in range(0, len(own), width))


def notices() -> list[tuple[str, str, str]]:
    """Family, notice and the text around it, over 2 to 40 lines."""
    out = []
    for family, templates in scan.TEMPLATES.items():
        for t in templates:
            n = len(t.split())
            for width in {1, 2, 3, 5, 8, 13} if n > 8 else {1, 2, 3}:
                if width < n:
                    notice = wrap(t, width, "" if width < 3 else "#")
                    k = len(out)
                    out.append((family, notice, f"{prose(k, 25)}\n\n{notice}\n\n{prose(900 + k, 25)}"))
    return out


def test_windows_around_anchors_are_those_of_all_ranges(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts = [t for t in texts if t and t.count("\n") < 60] + [t for _, _, t in notices()]
    texts += [f"{a}\n{b}" for (_, a, _), (_, b, _) in zip(notices()[::5], notices()[1::5])]
    rarity = {b"license": 9, b"the": 50, b"of": 40, b"is": 30, b"or": 30, b"you": 9}
    assert found_windows(texts, rarity) == [all_windows(t) for t in texts]


def test_every_window_has_an_anchor():
    for template in scan.read_templates({}, PARAMS.least_match):
        bits = sum(bin(template.places[a]).count("1") for a in template.anchors)
        assert template.size - bits < PARAMS.least_match * template.size


def test_notices_of_2_to_40_lines_are_found(spark):
    made = notices()
    assert max(n.count("\n") + 1 for _, n, _ in made) >= 38
    docs = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(made)], "doc_id long, text string")
    got = {r.doc_id: r for r in scan.license_scan(docs).collect() if r.confirmed}
    right = [i for i, (family, n, t) in enumerate(made) if i in got and got[i].family == family]
    assert len(right) >= 0.9 * len(made)
    for i in right:
        assert made[i][2][got[i].begin : got[i].end] in made[i][1]


def test_odd_rows(spark, odd):
    long = spark.createDataFrame([(1, "x" * 2_000_000), (2, "license " * 50_000), (3, "mit\nlicense\n" * 20_000)], "doc_id long, text string")
    for docs in (odd, long, odd.limit(0)):
        assert scan.license_scan(docs).filter("confirmed").count() == 0


def test_memory_of_a_worker(spark):
    """The scan of the whole larger table in one worker, which kept all windows of a block at a time."""
    model = scan.train(spark.read.parquet(f"{SMALL}/documents.parquet"))
    rows = [r.text for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("text").collect()]

    run = scan.scanner(types.SimpleNamespace(value=model), scan.LicenseParams())

    def peak(batches):
        n = sum(b.num_rows for b in run(batches))
        yield pa.RecordBatch.from_pydict({"n": [n], "mb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024]})

    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").coalesce(1)
    found = df.mapInArrow(peak, "n long, mb long").first()
    assert found.mb < 500 and found.n > 0

