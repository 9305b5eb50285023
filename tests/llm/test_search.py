"""Vector search against brute force."""

import math

import numpy as np

from strata.llm.mtree import Tree as MTree
from strata.llm.mtree import top_inner_products
from strata.llm.vptree import Tree as VpTree
from strata.llm.vptree import nearest_by_cosine, recall

SCHEMA = "vec_id long, embedding array<float>, label int, shard long, block int, dim int, image binary, rank int, score double"


def vectors(n=230, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[60:70] = x[50]                                         # ties
    out = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    out[10] = (10, None)
    out[11] = (11, [1.0, None, 0.0, 0.0, 0.0, 0.0])
    out[12] = (12, [1.0, math.nan, 0.0, 0.0, 0.0, 0.0])
    out[13] = (13, [1.0, math.inf, 0.0, 0.0, 0.0, 0.0])
    out[14] = (14, [0.0] * dim)
    out[15] = (15, [])
    out += [out[20], (None, [1.0] * dim), (300, [1.0, 2.0]), (350, [2.0, 1.0])]   # repeated row, null id, other length
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, b"", 5, 0.5) for i, v in data], SCHEMA)


def good(data, zero_ok):
    seen = {}
    for i, v in data:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        if not zero_ok and not any(v):
            continue
        seen[i] = np.array(v, np.float64)
    return seen


def brute(data, score, zero_ok):
    v = good(data, zero_ok)
    out = []
    for q in sorted(v):
        if q % 50 == 0:
            s = sorted(((score(v[q], v[c]), c) for c in v if c != q and len(v[c]) == len(v[q])),
                       key=lambda t: (-t[0], t[1]))[:5]
            out += [(q, k + 1, c, x) for k, (x, c) in enumerate(s)]
    return out


def is_query(c):
    return c % 50 == 0


def test_inner_products(spark):
    data = vectors()
    want = brute(data, lambda a, b: int(np.floor(256 * a) @ np.floor(256 * b)), True)
    for shard_rows in (8192, 40):
        got = top_inner_products(frame(spark, data), is_query, shard_rows=shard_rows, page=8).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want


def cosine(a, b):
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


def test_exact_cosine_with_factor_one(spark):
    data = vectors()
    want = brute(data, lambda a, b: round(cosine(a, b), 12), False)
    for shard_rows in (8192, 40):
        got = nearest_by_cosine(frame(spark, data), is_query, factor=1.0, leaf=8, shard_rows=shard_rows).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in got) == want


def test_recall_of_the_default_factor(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = nearest_by_cosine(df, is_query)
    exact = nearest_by_cosine(df, is_query, factor=1.0)
    assert recall(found, exact) >= 0.95


def test_trees_match_brute_force():
    rng = np.random.default_rng(2)
    ids = np.arange(1500)
    x = rng.normal(size=(1500, 12))
    xi = np.floor(256 * x)
    m, v = MTree(ids, xi, 16), VpTree(ids, x, 16)
    for q in range(0, 1500, 100):
        s = (xi @ xi[q]).astype(int)
        best = [int(c) for c in np.lexsort((ids, -s)) if c != q][:5]
        assert sorted(m.search(q, xi[q], 5), key=lambda t: (-t[0], t[1])) == [(int(s[c]), c) for c in best]
        c = v.unit @ v.unit[q]
        assert v.search(q, x[q], 5, 1.0).tolist() == [int(i) for i in np.lexsort((ids, -c)) if i != q][:5]


def test_too_few_and_none(spark):
    data = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]
    assert [(r.query_id, r.vec_id) for r in top_inner_products(frame(spark, data), is_query).collect()] == [(0, 1), (0, 2)]
    assert nearest_by_cosine(frame(spark, data), is_query).count() == 2
    none = spark.createDataFrame([], SCHEMA)
    assert top_inner_products(none, is_query).count() == 0 and nearest_by_cosine(none, is_query).count() == 0
