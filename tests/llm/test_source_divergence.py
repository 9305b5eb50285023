"""Source divergence and its pattern tree against brute force."""

import random
import re
from collections import Counter

import numpy as np

from strata.llm.source_divergence import PatternTree, share, source_divergence, term_rows
from tests.llm.data import SCHEMA, empty, frame

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_docs=3, top=200):
    """docs: (text, lang, source)"""
    docs = [(TERM.findall((t or "").translate(LOWER)), lang or "", s or "") for t, lang, s in docs]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        df = Counter(w for ws, _, _ in mine for w in set(ws))
        kept = {w for w, n in df.items() if n >= min_docs}
        counts = {s: Counter() for _, _, s in mine}
        for ws, _, s in mine:
            counts[s].update(w for w in ws if w in kept)
        whole = sum(counts.values(), Counter())

        def p(c, w):
            return 1 + 10 ** 9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        for s, c in counts.items():
            pairs = [(t, sum((p(c, w) - p(d, w)) ** 2 // p(d, w) for w in kept)) for t, d in counts.items() if t != s]
            terms = [(w, (p(c, w) - p(whole, w)) ** 2 // p(whole, w)) for w in c if p(c, w) > p(whole, w)]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, w, v, k + 1) for k, (w, v) in enumerate(items)]
    return sorted(out)


def documents(seed=3, n=150):
    rng = random.Random(seed)
    vocabulary = ["ba", "Be", "bi's", "été", "ÉTÉ", "日本", "😀x", "co-op", "x1y", "don't"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(0, 40), weights=[1 / (1 + k) for k in range(len(vocabulary))])
        lang = rng.choice(["en", "en", "en", "de", None])
        source = "big" if rng.random() < 0.4 else rng.choice(["a", "b", "c", "d", None, "é"])
        rows.append((" ".join(words).swapcase() if i % 9 == 0 else " ".join(words), lang, source))
    rows += [(None, "en", "silent"), ("", "xx", "only"), ("lonely words", "xx", "two"), ("ba " * 3000, "en", "long")]
    rows += [rows[5]] * 3
    return rows


def run(spark, docs, **kw):
    full = [(i, t, lang, s, 0, 1, 2, 3, 4, 0.9, 5, 6, 7, 8, 9) for i, (t, lang, s) in enumerate(docs)]
    out = source_divergence(frame(spark, full), **kw)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in out.collect())


def test_divergence_equals_brute_force(spark):
    docs = documents()
    assert run(spark, docs) == brute(docs)
    assert run(spark, docs, top_terms=3, min_docs=10) == brute(docs, 10, 3)


def test_counts_that_leave_early_add_up(spark):
    docs = documents(8, 80)
    full = frame(spark, [(i, t, lang, s, 0, 1, 2, 3, 4, 0.9, 5, 6, 7, 8, 9) for i, (t, lang, s) in enumerate(docs)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        parts = [sorted((r["lang"], r["term"], r["lang_count"], tuple(sorted(map(tuple, r["items"])))) for r in
                        term_rows(full, "text", "lang", "source", 2, held).collect()) for held in (1, 10 ** 6)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert parts[0] == parts[1] and len(parts[0]) > 30


def test_awkward_rows_and_no_terms(spark):
    got = run(spark, [("ba be", "en", "s"), (None, None, None), ("x", "en", "t")])
    assert got == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert source_divergence(empty(spark)).count() == 0
    assert "text" in SCHEMA


def test_share_is_exact_for_large_counts(spark):
    cases = [(0, 1), (0, 7), (12, 13), (10 ** 14, 3 * 10 ** 14), (8 * 10 ** 15 - 1, 8 * 10 ** 15), (1, 0)]
    df = spark.createDataFrame(cases, "c long, t long").selectExpr("c", "t", f"{share('c', 't')} AS p")
    for r in df.collect():
        assert r["p"] == (None if r["t"] == 0 else 1 + 10 ** 9 * (r["c"] + 1) // r["t"])


def test_tree_shares_common_beginnings():
    # rows (source, count): a1 b2 | a1 b2 c1 | a1 c1 | b2, the second with three terms
    rows = [[(1, 1), (2, 2)], [(1, 1), (2, 2), (3, 1)], [(1, 1), (3, 1)], [(2, 2)]]
    flat = [x for r in rows for x in r]
    rank, count = (np.array(c, np.int64) for c in zip(*flat))
    tree = PatternTree(np.zeros(4, np.int64), np.array([1, 3, 1, 1]), np.array([0, 2, 5, 7, 8]),
                       rank, count, count * 100, np.full(8, 10, np.int64))
    assert tree.rank.tolist() == [1, 2, 3, 3, 2]
    assert tree.parent.tolist() == [-1, 0, 1, 0, -1]
    assert tree.times.tolist() == [5, 4, 3, 1, 1]

    def f(p, q):
        return (p - q) ** 2 // q

    want = {}
    for r, m in zip(rows, (1, 3, 1, 1)):
        for i, (s, c) in enumerate(r):
            for t, d in r[i + 1:]:
                for k, (x, y) in enumerate(((c, d), (d, c))):
                    v = f(100 * x, 100 * y) - f(100 * x, 10) - f(10, 100 * y) + f(10, 10)
                    want.setdefault((s, t), [0, 0])[k] += m * v
    lang, s, t, st, ts = tree.corrections()
    assert {(a, b): [x, y] for a, b, x, y in zip(s.tolist(), t.tolist(), st.tolist(), ts.tolist())} == want
