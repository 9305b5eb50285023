"""Inverted multi-index against brute force."""

import math

import numpy as np

from strata.llm.multi_index import Grid, _forest, centroids, near_duplicate_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, cell long, part int, home long, copies long, digest int"


def vectors(seed=5, dim=16):
    """Random vectors, near copies at several distances, a large group of near
    copies, exact and scaled copies, and rows that take no part."""
    rng = np.random.default_rng(seed)
    x = [v for v in rng.normal(size=(250, dim))]
    for i in range(60):
        x.append(x[i] + rng.normal(size=dim) * rng.choice([0.01, 0.1, 0.2, 0.3]))
    x += [x[3] + rng.normal(size=dim) * 0.02 for _ in range(120)]
    x += [x[7]] * 40 + [x[8] * 1000.0, x[9] * 1e-30, -x[10]]
    out = [(i, [float(a) for a in np.asarray(v, np.float32)]) for i, v in enumerate(x)]
    order = rng.permutation(len(out))
    out = [(int(order[i]), v) for i, v in out]
    out += [(1000, None), (1001, []), (1002, [0.0] * dim), (1003, [math.nan] + [1.0] * (dim - 1)),
            (1004, [math.inf] + [1.0] * (dim - 1)), (1005, [None] + [1.0] * (dim - 1)), (None, out[0][1]),
            (1006, [1.0]), (1007, [2.0]), (1008, [-1.0]), (1009, [1.0, 2.0]), (1010, [1.0, 2.1]), out[11], out[11],
            (1000, out[12][1])]
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, 4, 5, 6) for i, v in data], SCHEMA)


def brute(data, least=0.95):
    good, ids = {}, {i for i, _ in data if i is not None}
    for i, v in data:
        if i is not None and v and all(a is not None and math.isfinite(a) for a in v) and any(v):
            good[i] = np.asarray(v, np.float64)
    links = {i: set() for i in ids}
    for i, u in good.items():
        for j, v in good.items():
            if i != j and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= least:
                links[i].add(j)
    out = []
    for i in ids:
        seen, stack = {i}, [i]
        while stack:
            new = links[stack.pop()] - seen
            seen |= new
            stack += new
        out.append((i, len(links[i]), min(seen), min(seen) == i))
    return sorted(out)


def test_links_and_components(spark):
    data = vectors()
    want = brute(data)
    found = sorted(tuple(r) for r in near_duplicate_vectors(frame(spark, data)).collect())
    assert [r[0] for r in found] == [r[0] for r in want]
    assert all(a[1] <= b[1] for a, b in zip(found, want))                # none below the threshold
    assert sum(r[1] for r in found) >= 0.98 * sum(r[1] for r in want)
    assert sum(a == b for a, b in zip(found, want)) >= 0.95 * len(want)


def test_full_margin_and_small_blocks_are_exact(spark, monkeypatch):
    data = vectors(6)
    monkeypatch.setattr("strata.llm.multi_index.LEAST_MARGIN", math.sqrt(0.1))
    found = near_duplicate_vectors(frame(spark, data), block=13, cell_rows=8)
    assert sorted(tuple(r) for r in found.collect()) == brute(data)


def test_empty_and_unusable(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    out = near_duplicate_vectors(frame(spark, [(1, None), (2, [0.0, 0.0]), (3, [1.0, 0.0])]))
    assert sorted(tuple(r) for r in out.collect()) == [(i, 0, i, True) for i in (1, 2, 3)]


def test_traversal_visits_cells_in_order_of_distance():
    rng = np.random.default_rng(1)
    u = rng.normal(size=(30, 10))
    grid = Grid(centroids(u[:, :5], 6, 1), centroids(u[:, 5:], 7, 2))
    a, b = grid.distances(u)
    whole = np.sqrt(a[:, :, None] + b[:, None, :]).reshape(len(u), -1)
    for margin in (0.0, 0.3, 100.0):
        for row, cells, home in zip(whole, grid.traverse(u, margin), grid.home(u)[0]):
            assert cells[0] == home and len(set(cells)) == len(cells)
            assert (np.diff(row[cells]) >= -1e-12).all()
            assert len(cells) == (row <= row.min() + margin + 1e-9).sum()


def test_forest_spans_the_links():
    rng = np.random.default_rng(4)
    root = np.arange(200)
    pairs = rng.integers(0, 200, size=(150, 2))
    want = np.arange(200)
    for a, b in pairs:
        want[want == want[b]] = want[a]
    x, y = zip(*(_forest(root, p[:, 0], p[:, 1]) for p in (pairs[:70], pairs[70:])))
    x, y = np.concatenate(x), np.concatenate(y)
    assert len(x) == 200 - len(set(want.tolist()))                       # no edge too many
    got = np.arange(200)
    for a, b in zip(x, y):
        got[got == got[b]] = got[a]
    assert ((got[:, None] == got) == (want[:, None] == want)).all()
