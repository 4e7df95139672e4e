"""Licence scans: a trained paragraph classifier, confirmed against templates.

Paragraphs are lines, and neighbouring lines over which a notice is wrapped. A softmax regression over
hashed words, pairs and triples of words tells the licence families apart and from everything else, the
unknown class. It is trained on the templates, whole, in part and with words lost or replaced, and on
paragraphs of a bounded sample of documents; its temperature is fitted on examples held back. What it takes
for a licence is compared with the templates of that family, word by word in order, and confirmed or not.

Wrapped notices are looked for around anchors: of a template, the rarest words that together are more than
a notice may lack. Every notice has one of them, and other text hardly any, so only the lines around
anchors are compared with the template.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import linear, tables, words

# Families and sentences by which their licences are named or granted.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "all-rights-reserved": ["Copyright. All rights reserved.", "No part may be reproduced without written permission."],
}
FAMILIES = list(TEMPLATES)


@dataclass(frozen=True)
class LicenseParams:
    """``sample`` is about how many documents the unknown class is learned from. A notice over several lines
    has at most ``spread`` times the words of its template; ``batch_words`` bounds how many words are
    classified at a time."""

    sample: int = 300
    bits: int = 16
    copies: int = 45
    rounds: int = 50
    threshold: float = 0.5
    least_match: float = 0.75
    spread: int = 2
    batch_words: int = 100_000


def template_words(text: str) -> list[bytes]:
    """Words as the scan sees them: letters and digits, A to Z in lower case."""
    raw = text.encode().lower()
    found = words.find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), words.ALNUM)
    return [raw[a:b] for a, b in zip(found.starts, found.ends)]


def match(paragraph: list[bytes], template: list[bytes]) -> float:
    """Share of a template's words that the paragraph has in the same order."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(template):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(template)) - 1
    free = full
    for word in paragraph:  # bits that turn 0 count the longest common subsequence
        taken = free & places.get(word, 0)
        free = (free + taken | free - taken) & full
    return (len(template) - free.bit_count()) / max(len(template), 1)


def _grams(hashed: np.ndarray, first: np.ndarray, bits: int) -> linear.Sparse:
    """Distinct buckets of words, pairs and triples of each paragraph, of length one in all."""
    sizes = np.diff(first)
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    key = [row * (1 << bits) + (hashed & np.uint64((1 << bits) - 1)).astype(np.int64)]
    for n in (2, 3):
        runs, begins = words.neighbours(hashed, first, n)
        of = np.repeat(np.arange(len(sizes), dtype=np.int64), np.diff(begins))
        key.append(of * (1 << bits) + (runs & np.uint64((1 << bits) - 1)).astype(np.int64))
    key = np.unique(np.concatenate(key))
    begins = np.searchsorted(key >> bits, np.arange(len(sizes) + 1))
    value = np.repeat(1 / np.sqrt(np.maximum(np.diff(begins), 1)), np.diff(begins))
    return linear.Sparse((key & ((1 << bits) - 1)).astype(np.int32), value.astype(np.float32), begins)


def paragraphs(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places where lines begin and end; a text's line breaks belong to the line before them."""
    return np.unique(np.concatenate([places, np.flatnonzero(data == 10) + 1]))


@dataclass(frozen=True)
class Template:
    """Words of a template as hashes, where each stands, as bits, and those that are its anchors."""

    size: int
    places: dict[int, int]
    anchors: list[int]


def read_templates(rarity: dict[bytes, int], least_match: float) -> list[Template]:
    """All templates; ``rarity`` has how often each of their words occurs elsewhere."""
    out = []
    for own in (template_words(t) for ts in TEMPLATES.values() for t in ts):
        hashes = dict(zip(own, _hashed_words(own)))
        places: dict[int, int] = {}
        for i, word in enumerate(own):
            places[hashes[word]] = places.get(hashes[word], 0) | 1 << i
        lacking, anchors = len(own) - math.ceil(least_match * len(own) - 1e-9), []
        for word in sorted(set(own), key=lambda w: (rarity.get(w, 0), w)):
            if lacking < 0:
                break
            anchors.append(hashes[word])
            lacking -= own.count(word)
        out.append(Template(len(own), places, anchors))
    return out


def _hashed_words(own: list[bytes]) -> list[int]:
    data = b" ".join(own)
    return _hashed(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[1].tolist()


def wrapped(
    found: words.Words, hashed: np.ndarray, text: np.ndarray, templates: list[Template], params: LicenseParams
) -> list[tuple[int, int]]:
    """First and after the last line of neighbouring lines of a text that hold most of a template; no blank
    line is among them. For each first line and template the window that holds most of it, the shortest of
    those."""
    line = found.text
    blank = np.diff(found.first) == 0
    new_text = np.append(False, text[1:] != text[:-1])
    stretch = np.cumsum(blank | new_text)[line]  # neighbouring lines of a text without a blank one between
    anchors = np.unique(np.array([a for t in templates for a in t.anchors], np.uint64))
    at = np.minimum(np.searchsorted(anchors, hashed), len(anchors) - 1)
    hits = np.flatnonzero(anchors[at] == hashed)
    out: set[tuple[int, int]] = set()
    for template in templates:
        own = hits[np.isin(hashed[hits], np.array(template.anchors, np.uint64))]
        most = params.spread * template.size
        for begin, end in _around(own, most, stretch):
            # Whole lines.
            begin, end = int(found.first[line[begin]]), int(found.first[line[end - 1] + 1])
            bits = [template.places.get(h, 0) for h in hashed[begin:end].tolist()]
            out.update(_windows(bits, line[begin:end].tolist(), template.size, most, params.least_match))
    return sorted(out)


def _around(hits: np.ndarray, most: int, stretch: np.ndarray) -> list[tuple[int, int]]:
    """Words up to ``most`` away from hits, in the same stretch, as ranges that don't overlap."""
    out: list[tuple[int, int]] = []
    for hit in hits.tolist():
        begin = max(hit - most, int(np.searchsorted(stretch, stretch[hit])))
        end = min(hit + most + 1, int(np.searchsorted(stretch, stretch[hit], "right")))
        if out and begin < out[-1][1]:
            begin = out.pop()[0]
        out.append((begin, end))
    return out


def _windows(bits: list[int], line: list[int], size: int, most: int, least_match: float) -> list[tuple[int, int]]:
    """Windows of two lines or more. ``bits`` has the places of each word in the template, ``line`` its line."""
    full = (1 << size) - 1
    needed = math.ceil(least_match * size - 1e-9)
    out = []
    for i, own in enumerate(line):
        if i and line[i - 1] == own:
            continue
        free, best = full, (needed - 1, 0)
        for j in range(i, min(i + most, len(bits))):
            taken = free & bits[j]
            if taken:  # bits that turn 0 count the longest common subsequence
                free = (free + taken | free - taken) & full
            if line[j] > own and (j + 1 == len(line) or line[j + 1] > line[j]) and size - free.bit_count() > best[0]:
                best = size - free.bit_count(), line[j] + 1
        if best[1]:
            out.append((own, best[1]))
    return out


def _hashed(data: np.ndarray, places: np.ndarray) -> tuple[words.Words, np.ndarray]:
    found = words.find_words(data, places, words.ALNUM)
    return found, words.hash_words(data, found, lower=True)[0]


def training_lines(params: LicenseParams) -> tuple[list[bytes], list[int]]:
    """Templates whole, in runs of at least half their words, and with words lost or replaced."""
    rng, lines, families = np.random.default_rng(11), [], []
    for family, templates in enumerate(TEMPLATES.values(), start=1):
        for template in map(template_words, templates):
            for copy in range(params.copies):
                part = list(template)
                if copy % 3 == 1:
                    size = int(rng.integers((len(part) + 1) // 2, len(part) + 1))
                    begin = int(rng.integers(0, len(part) - size + 1))
                    part = part[begin : begin + size]
                elif copy % 3 == 2:
                    keep = rng.random(len(part)) > 0.15
                    part = [w if k else b"w%d" % rng.integers(1 << 30) for w, k in zip(part, keep)]
                lines.append(b" ".join(part))
                families.append(family)
    return lines, families


def fit(batches: Iterator[pa.RecordBatch], params: LicenseParams) -> dict[str, bytes]:
    lines, y = training_lines(params)
    templates = [template_words(t) for ts in TEMPLATES.values() for t in ts]
    named, trained = {w for t in templates for w in t}, set(lines)
    rarity: Counter = Counter(dict.fromkeys(named, 0))
    for batch in batches:
        for line in sorted({x for text in words.column(batch, "text").to_pylist() for x in text.encode().split(b"\n")}):
            plain = template_words(line.decode())
            own = named.intersection(plain)
            nearest = max((match(plain, t) for t in templates), default=0) if own else 0
            if plain and nearest < 0.5 and b" ".join(plain) not in trained:
                lines.append(line)
                y.append(0)
                rarity.update(own)
    data = np.frombuffer(b"".join(lines), np.uint8)
    places = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
    found, hashed = _hashed(data, places)
    x, y, dims = _grams(hashed, found.first, params.bits), np.array(y), 1 << params.bits
    fitted = np.arange(len(y)) % 4 != 0
    kept = fitted[x.row]
    sizes = np.diff(x.first)[fitted]
    part = linear.Sparse(x.index[kept], x.value[kept], np.concatenate([[0], np.cumsum(sizes)]))
    weights, bias = linear.fit_logistic(part, y[fitted], dims, params.rounds)
    z = bias + words.sums_by(weights[x.index] * x.value[:, None], x.first)
    held = ~fitted
    losses = [-np.log(linear.softmax(z[held] / t)[np.arange(held.sum()), y[held]] + 1e-12).mean() for t in _TEMPERATURES]
    temperature = _TEMPERATURES[int(np.argmin(losses))]
    return {
        "weights": (weights / temperature).astype(np.float32).tobytes(),
        "bias": (bias / temperature).tobytes(),
        "rarity": b"\n".join(b"%s %d" % x for x in sorted(rarity.items())),
    }


_TEMPERATURES = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]


def train(docs: DataFrame, params: LicenseParams = LicenseParams()) -> dict[str, bytes]:
    """A model; the unknown class is learned from about ``params.sample`` documents, chosen by hash.

    Lines that hold half of a template's words aren't taken for examples of the unknown class.
    """
    texts = docs.select("text")
    every = max(1, texts.count() // params.sample)
    # Copies of a text have the same hash; one of them is taken.
    chosen = texts.filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).distinct()
    chosen = chosen.orderBy(F.xxhash64(F.lit(1), "text"), "text").limit(2 * params.sample)
    return tables.fit_in_one_task(chosen, lambda batches: fit(batches, params))


def scan(docs: DataFrame, model: dict[str, bytes], params: LicenseParams = LicenseParams()) -> DataFrame:
    """``doc_id, paragraph, begin, end, family, probability, similarity, confirmed``, one row per
    paragraph that the classifier takes for a licence.

    ``paragraph`` counts lines from 0; ``begin`` and ``end`` are its places in characters. A notice over
    several lines is one paragraph, that of its first line, and its lines aren't reported on their own.
    ``confirmed`` says whether the paragraph has, in order, at least ``least_match`` of a template of
    the family. NULL and empty texts have no paragraphs; repeated rows, and rows with the same or no id, are
    rows of their own; other columns aren't read, and an empty table gives none. Of notices that overlap, the
    one with most of a template counts, then the one over fewest lines, then the first.
    """
    shipped = tables.ship(docs.sparkSession, model)
    narrow = docs.select("doc_id", "text")
    ddl = (
        "paragraph int, begin long, end long, family string, probability double, similarity double, confirmed boolean"
    )
    return narrow.mapInArrow(scanner(shipped, params), tables.arrow_fields(narrow.select("doc_id"), ddl))


def scanner(shipped: Broadcast, params: LicenseParams) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task of ``scan`` does with its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shipped.value["weights"], np.float32).reshape(-1, len(FAMILIES) + 1)
        bias = np.frombuffer(shipped.value["bias"])
        templates = {f: [template_words(t) for t in ts] for f, ts in TEMPLATES.items()}
        counted = (row.split() for row in shipped.value["rarity"].split(b"\n"))
        anchored = read_templates({word: int(n) for word, n in counted}, params.least_match)

        def chances(hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
            x = _grams(hashed, first, params.bits)
            return linear.softmax(bias + words.sums_by(weights[x.index] * x.value[:, None], x.first))

        def whole(windows: list[tuple[int, int]], found: words.Words, hashed: np.ndarray) -> Iterator[tuple]:
            """Windows and their chances, some ``batch_words`` words at a time."""
            while windows:
                sizes = np.cumsum([found.first[b] - found.first[a] for a, b in windows])
                some = max(1, int(np.searchsorted(sizes, params.batch_words, "right")))
                own, windows = windows[:some], windows[some:]
                joined = np.concatenate([hashed[found.first[a] : found.first[b]] for a, b in own])
                yield from zip(chances(joined, np.concatenate([[0], sizes[:some]])), own)

        def judge(data: np.ndarray, found: words.Words, chance: np.ndarray, at: int, to: int) -> dict:
            """Of the lines from ``at`` to before ``to``, compared with the templates of the likeliest family."""
            family, own = FAMILIES[int(chance[1:].argmax())], slice(found.first[at], found.first[to])
            plain = [data[a:b].tobytes().lower() for a, b in zip(found.starts[own], found.ends[own])]
            similarity = max(match(plain, t) for t in templates[family])
            confirmed = similarity >= params.least_match
            out = {"at": at, "to": to, "family": family, "probability": float(chance[1:].max())}
            return out | {"similarity": similarity, "confirmed": confirmed}

        for batch in batches:
            rows: dict[str, list] = {name: [] for name in ("row", *_names)}
            for first, _, data, places in words.blocks(batch):
                lines = paragraphs(data, places)
                found, hashed = _hashed(data, lines)
                chance = chances(hashed, found.first)
                chance[np.diff(found.first) == 0] = 0
                of = np.searchsorted(places, lines[:-1], "right") - 1
                judged = [judge(data, found, x, at, at + 1) for at, x in enumerate(chance) if x[1:].max() >= params.threshold]
                alone = {r["at"] for r in judged if r["confirmed"]}
                several = wrapped(found, hashed, of, anchored, params) if len(hashed) else []
                several = [(a, b) for a, b in several if alone.isdisjoint(range(a, b))]
                if several:
                    likely = (x for x in whole(several, found, hashed) if x[0][1:].max() >= params.threshold)
                    notices = [judge(data, found, x, *ab) for x, ab in likely]
                    # The most of a template first, then the fewest lines; no line is in two notices.
                    taken: set[int] = set()
                    notices = [r for r in notices if r["confirmed"]]
                    for r in sorted(notices, key=lambda r: (-r["similarity"], r["to"] - r["at"], r["at"])):
                        if taken.isdisjoint(range(r["at"], r["to"])):
                            taken |= set(range(r["at"], r["to"]))
                            judged = [j for j in judged if not r["at"] <= j["at"] < r["to"]] + [r]
                for r in sorted(judged, key=lambda r: r["at"]):
                    at, end = r.pop("at"), r.pop("to")
                    text = int(of[at])
                    begin = len(data[places[text] : lines[at]].tobytes().decode())
                    shown = data[lines[at] : lines[end]].tobytes().decode().rstrip("\n")
                    line = int(at - np.searchsorted(lines, places[text]))
                    r |= {"row": first + text, "paragraph": line, "begin": begin, "end": begin + len(shown)}
                    for name, value in r.items():
                        rows[name].append(value)
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(rows.pop("row"), pa.int64()))
            values = [pa.array(rows[name], kind) for name, kind in _names.items()]
            yield pa.RecordBatch.from_arrays([ids, *values], ["doc_id", *_names])

    return run


_names = {
    "paragraph": pa.int32(),
    "begin": pa.int64(),
    "end": pa.int64(),
    "family": pa.string(),
    "probability": pa.float64(),
    "similarity": pa.float64(),
    "confirmed": pa.bool_(),
}


def license_scan(docs: DataFrame, params: LicenseParams = LicenseParams()) -> DataFrame:
    """``train`` and ``scan`` of the same documents; see there for odd rows."""
    return scan(docs, train(docs, params), params)
