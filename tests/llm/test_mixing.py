"""Mixing: targets in closed form against repeated sharing, exact totals,
permutations, and the texts of the mix."""

import collections
import re

from pyspark.sql import functions as F

from strata.llm import mixing as mx
from tests.llm.data import empty, frame, rows

WORD = re.compile(mx.WORD)


def shared(words):
    """Targets by sharing the excess again and again."""
    names = sorted(words, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    full, open_ = {}, set(names)
    while True:
        left = 1.5 * sum(words.values()) - sum(full.values())
        got = {s: left * w[s] / sum(w[o] for o in open_) for s in open_} if open_ else {}
        over = {s for s in open_ if got[s] > 2 * words[s] + 1e-9}
        if not over:
            return {**full, **got}
        full.update({s: 2.0 * words[s] for s in over})
        open_ -= over


def test_words_taken(spark):
    docs = frame(spark)
    got = mx.mixed_words(docs, block_words=32, shard_slots=16).collect()
    size = collections.Counter()
    source = collections.defaultdict(list)
    for i, t, _, s, *_ in rows():
        size[s] += len(WORD.findall(t or ""))
        source[i, len(WORD.findall(t or ""))].append(s)
    want = shared(size)
    assert len(got) == len(rows())
    taken, seen = collections.Counter(), {}
    for r in got:
        s = source[r.doc_id, r.size][0] if len(set(source[r.doc_id, r.size])) == 1 else None
        assert r.taken <= 2 * r.size and abs(r.target - want[s]) < 1e-6 and r.source_size == size[s]
        taken[s] += r.taken
        seen[s] = r.target
    assert all(abs(taken[s] - seen[s]) <= 0.5 + 1e-9 for s in seen)
    again = mx.mixed_words(docs.repartition(7), block_words=32, shard_slots=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_blocks_and_documents_agree(spark):
    docs = frame(spark)
    per_doc = mx.mixed_words(docs, block_words=32, shard_slots=16).agg(F.sum("taken")).first()[0]
    blocks = mx.mixed_blocks(docs, block_words=32, shard_slots=16)
    assert blocks.agg(F.sum("n_words")).first()[0] == per_doc
    assert blocks.selectExpr("sum(aggregate(pieces, 0L, (a, p) -> a + p.n))").first()[0] == per_doc
    assert blocks.groupBy("source", "pass", "block").count().filter("count > 1").count() == 0
    out = mx.mixed_documents(docs, block_words=32, shard_slots=16)
    assert out.columns == docs.columns
    texts = collections.defaultdict(list)
    for i, t, *_ in rows():
        texts[i].append(t or "")
    total = 0
    for r in out.collect():
        words = WORD.findall(r.text)
        total += len(words)
        assert r.n_chars == len(r.text) and r.n == 8
        assert any(r.text == t or not collections.Counter(words) - collections.Counter(WORD.findall(t))
                   for t in texts[r.doc_id])
    assert total == per_doc


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 7, 100, 513):
        p = mx.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(9))
        got = [r[0] for r in spark.range(n).select(p).collect()]
        assert sorted(got) == list(range(n))
        assert n < 100 or got != list(range(n))


def test_empty_and_wordless(spark):
    assert mx.mixed_words(empty(spark)).count() == 0
    assert mx.mixed_documents(empty(spark)).count() == 0
    bare = frame(spark, [r for r in rows() if not (r[1] or "").split()])
    assert {(r.size, r.taken, r.target) for r in mx.mixed_words(bare).collect()} == {(0, 0, 0.0)}


def test_no_python_in_the_plan(spark):
    plan = mx.mixed_words(frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan
