"""Byte and word passage removal against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from strata.llm import chunks as ch
from strata.llm import repeats as rp
from strata.llm.chunks import Plan
from strata.llm.lpf_dedup import _packed, _unpacked, longest_previous_factor, remove_repeated_bytes, suffix_ranks
from strata.llm.recompression import remove_repeated_words, window_signatures
from tests.llm.data import empty, frame, rows, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(data, units_of, width, join):
    """One tuple per row: windows of rows with an id, smallest id wins."""
    seqs = [(i, units_of((t or "").encode())) for i, t, *_ in data]
    first = {}
    for i, u in seqs:
        for k in range(len(u) - width + 1):
            w = tuple(u[k:k + width])
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = []
    for i, u in seqs:
        keep = [True] * len(u)
        for k in range(len(u) - width + 1):
            if i is not None and first[tuple(u[k:k + width])] < i:
                keep[k:k + width] = [False] * width
        spans = sum(not keep[j] and (j == 0 or keep[j - 1]) for j in range(len(u)))
        body = join(x for x, ok in zip(u, keep) if ok)
        out.append((i, len(u), len(u) - sum(keep), spans, hashlib.sha256(body).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("plan", [Plan(1), Plan(60_000, 6_000, 4_000)])
def test_words(spark, plan):
    got = remove_repeated_words(frame(spark), plan=plan).collect()
    want = brute(rows(), WORD.findall, 13, b" ".join)
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str) == \
        sorted([(a, b, c, e) for a, b, c, _, e in want], key=str)
    assert sum(c for _, _, c, _, _ in want) > 300
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("plan", [Plan(1), Plan(60_000, 6_000, 4_000)])
def test_bytes(spark, plan):
    got = remove_repeated_bytes(frame(spark), plan=plan).collect()
    want = brute(rows(), lambda b: b, 50, bytes)
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=str) == want
    assert sum(c for _, _, c, _, _ in want) > 1000


def test_hot_anchors(spark):
    """Anchors in more than two chunks go by windows; results stay."""
    plan = Plan(60_000, 6_000, 4_000, hot_chunks=2)
    got = remove_repeated_bytes(frame(spark), plan=plan).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=str) == \
        brute(rows(), lambda b: b, 50, bytes)
    got = remove_repeated_words(frame(spark), plan=plan).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str) == \
        sorted([(a, b, c, e) for a, b, c, _, e in brute(rows(), WORD.findall, 13, b" ".join)], key=str)


@pytest.mark.parametrize("operator", ["bytes", "words"])
def test_no_bucket_gathers_the_edges_of_a_passage(monkeypatch, operator):
    """A passage all documents share: the payload of the fullest bucket must
    not grow with the documents of a chunk, only with the chunks."""
    got = {}
    monkeypatch.setattr(rp, "remove_repeats", lambda docs, *parts: got.update(parts=parts))
    (remove_repeated_bytes if operator == "bytes" else remove_repeated_words)(None, plan=Plan(1))
    windows, run_keys, run_payload, window_keys = got["parts"][:4]
    rng = random.Random(3)
    passage = " ".join(words(rng, 60))
    buckets, chunks, fullest = 2000, 12, []
    for per_chunk in (10, 80):
        tables = [pa.table({"doc_id": pa.array(range(c * 1000, c * 1000 + per_chunk), pa.int64()), "text": pa.array(
            [" ".join([*words(rng, 20), passage, *words(rng, 20)]) for _ in range(per_chunk)])}) for c in range(chunks)]
        asks = pa.concat_tables(rp.ask_anchors(windows, buckets)((pa.scalar(c),), t) for c, t in enumerate(tables))
        by = [asks.filter(pc.equal(asks["bucket"], b)) for b in sorted(set(asks["bucket"].to_pylist()))]
        seen = pa.concat_tables(ch.answer_counts(rp.SEEN, 255)(t) for t in by)
        size = collections.Counter()
        for c, t in enumerate(tables):
            out = rp.ask_runs(windows, run_keys, run_payload, window_keys, buckets, 50 if operator == "bytes" else 13, 4)(
                (pa.scalar(c),), t, seen.filter(pc.equal(seen["chunk"], c)))
            for b, p in zip(out["bucket"].to_pylist(), out["payload"].to_pylist()):
                size[b] += len(p) if b >= 0 else 0
        fullest.append(max(size.values()))
    print(operator, fullest)
    assert fullest[1] < 3 * fullest[0]


def test_empty_tables(spark):
    assert remove_repeated_words(empty(spark)).count() == 0
    assert remove_repeated_bytes(empty(spark)).count() == 0


def test_signatures_tell_windows_apart():
    rng = np.random.default_rng(5)
    sym = rng.integers(1, 4, 3000).astype(np.uint64)       # few symbols: many runs and repeats
    row = np.repeat(np.arange(3), 1000)
    first, sig, anchor = window_signatures(sym, row, 13)
    by_text, by_sig = {}, {}
    for k, i in enumerate(first):
        w = tuple(sym[i:i + 13])
        by_text.setdefault(w, set()).add((int(sig[k]), int(anchor[k])))
        by_sig.setdefault(int(sig[k]), set()).add(w)
    assert all(len(v) == 1 for v in by_text.values()) and all(len(v) == 1 for v in by_sig.values())
    assert len(first) == 3 * (1000 - 12)


def test_suffix_order_and_factors():
    rng = np.random.default_rng(7)
    text = rng.integers(97, 99, 200).astype(np.uint8)
    padded = np.concatenate([text, np.zeros(20, np.uint8)])
    rank = suffix_ranks(padded, 20)[:200]
    raw = padded.tobytes()
    assert (np.argsort(rank, kind="stable") == sorted(range(200), key=lambda i: (raw[i:i + 20], i))).all()
    doc = rng.integers(0, 5, 200)
    lcp = np.concatenate([[0], rng.integers(0, 6, 199)])
    want = []
    for i in range(200):
        best = 0
        for step in (-1, 1):
            j, least = i, 10 ** 9
            while 0 <= j + step < 200:
                least = min(least, lcp[j] if step < 0 else lcp[j + 1])
                j += step
                if doc[j] < doc[i]:
                    best = max(best, least)
                    break
        want.append(best)
    assert longest_previous_factor(doc, lcp).tolist() == want


@pytest.mark.parametrize("letters", [1, 2, 200])
def test_suffix_order_at_chosen_starts(letters):
    """Only the starts asked for are ordered, as among all suffixes; ties stay ties."""
    rng = np.random.default_rng(letters)
    text = np.concatenate([rng.integers(1, 1 + letters, 600), rng.integers(1, 1 + letters, 90).repeat(3),
                           np.zeros(50, np.int64)]).astype(np.uint8)
    raw, at = text.tobytes(), rng.permutation(len(text) - 50)[:400]
    rank = suffix_ranks(text, 50, at)
    cut = [raw[i:i + 50] for i in at]
    smaller = {c: sum(d < c for d in cut) for c in set(cut)}
    assert rank.tolist() == [smaller[c] for c in cut]
    assert len(suffix_ranks(text, 50, at[:0])) == 0


def test_run_texts_are_packed():
    """What a run ships is under its own text where that repeats letters, and
    comes back unchanged; a few bytes are left as they are."""
    rng = random.Random(1)
    body = " ".join(words(rng, 3000)).encode()
    assert len(_packed(body)) < 0.6 * len(body)
    for b in (body, b"", b"\x00", bytes(range(256)), rng.randbytes(1000)):
        assert _unpacked(_packed(b)) == b and len(_packed(b)) <= len(b) + 4


def test_anchor_places_of_stretches():
    """Places are sought once a stretch of windows with one anchor and row."""
    rng = np.random.default_rng(2)
    row = np.sort(rng.integers(0, 5, 500))
    w = rp.Windows(row, np.arange(500), rng.integers(0, 9, 500).astype(np.uint64).repeat(3)[:500], np.arange(500))
    bucket, place, head, inverse, size = rp._anchor_places(w, 7)
    want = ch.distinct_places(rp.mix(w.anchor), 7)
    assert (bucket == want[0]).all() and (place == want[1]).all()
    assert (np.repeat(inverse, size) == want[2]).all() and len(head) < 400
    none = rp.Windows(*[np.zeros(0, np.int64)] * 2, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert [len(x) for x in rp._anchor_places(none, 7)] == [0] * 5
