"""Small tables and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    parts = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    made = ["".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(words)]
    return " ".join(w + "." if i % 9 == 8 else w for i, w in enumerate(made))


def shingles(text: str | None, n: int = 5) -> frozenset:
    words = WORD.findall(text or "")
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def jaccard_classes(rows: list[tuple]) -> Counter:
    """``(doc_id, class_id, n_links)`` of every row, by comparing all rows."""
    sets = [shingles(text) for _, text in rows]
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    out, seen = Counter(), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, waiting = {i}, [i]
        while waiting:
            new = links[waiting.pop()] - group
            group |= new
            waiting.extend(new)
        seen |= group
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            out[(rows[k][0], min(ids, default=None), len(links[k]))] += 1
    return out
