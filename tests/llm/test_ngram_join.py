"""Jaccard classes against brute force."""

import re

import pytest

from strata.llm.chunks import Plan
from strata.llm.components import connected_components
from strata.llm.ngram_join import near_duplicate_classes
from tests.llm.data import SCHEMA, empty, frame, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(data):
    parent = {i: i for i, *_ in data if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = [(i, shingles(t)) for i, t, *_ in data if i is not None]
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            k = len(x & y)
            if k and 100 * k >= 75 * (len(x) + len(y) - k):
                i, j = find(i), find(j)
                parent[max(i, j)] = min(i, j)
    return sorted(((i, len(shingles(t)), None if i is None else find(i)) for i, t, *_ in data), key=str)


@pytest.mark.parametrize("plan", [None, Plan(60_000, 6_000, 4_000)])
def test_classes(spark, plan):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id)
                  for r in near_duplicate_classes(frame(spark), plan=plan).collect()), key=str)
    want = brute(rows())
    assert got == want
    assert sum(i != c for i, _, c in want) > 8


def test_chain_of_near_copies(spark):
    """Each text links to the next only: the class is the whole chain."""
    base = [f"w{i}" for i in range(200)]
    data, t = [], list(base)
    for i in range(24):
        data.append((100 - i, " ".join(t)))
        t = t[8:] + [f"x{i}_{k}" for k in range(8)]
    data = [(i, t, "en", "s", 1, 1, 2, 3, 4, 0.9, 5, 6, 7, 8, 9) for i, t in data]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id)
                  for r in near_duplicate_classes(spark.createDataFrame(data, SCHEMA)).collect()), key=str)
    assert got == brute(data) and {c for _, _, c in got} == {77}


def test_empty_table(spark):
    assert near_duplicate_classes(empty(spark)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 7), (7, 5), (3, 3), (200, 105)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in [*range(100, 161), 200]}, 5: 5, 7: 5, 9: 5}
