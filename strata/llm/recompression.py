"""Passage removal by recompression (windows of words).

Locally consistent parsing of word sequences: a level first replaces each
maximal run of one symbol by a run symbol, then joins neighbouring symbols
whose classes are (left, right). Names are 64-bit hashes of what they stand
for, so every task gives equal runs and pairs the same name without a naming
shuffle; classes are bits of the names. Equal word sequences therefore get
the same interior symbols wherever they occur.

Each window of ``width`` words is followed through the levels as an interval
of symbols. At each level the symbols at its two ends that may be parsed
differently outside (the first and last run; a right-class first symbol, a
left-class last one) are taken off and folded into the window's signature;
what is left has the same parse in every occurrence. The interior symbols of
the highest level that leaves two or more are, as one name, the window's
anchor. Anchors found in more than one document reveal candidate repeats; equal signatures verify
them (64 bits; two different windows of a corpus of 10**12 windows under one
anchor collide with probability far below 10**-9 per bucket).

Words are taken unchanged. A window counts when its word sequence also starts
in a document with a smaller id, judged on the input.

Defined cases: null or empty text has no words; documents shorter than the
window lose nothing; rows with a null doc_id keep everything and do not count
as earlier copies; rows sharing a doc_id do not remove each other's words;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import repeats as rp
from strata.llm.textarrays import Texts, combine, mix, run_hash, word_bounds, word_hashes

WIDTH = 13
OUT = "doc_id long, text string, n_words long, n_removed long, kept_sha256 string"


def _renamed(sym: np.ndarray, row: np.ndarray, level: int):
    """Runs of one level: (start, end) per run, run of each symbol, run names."""
    head = np.ones(len(sym), bool)
    head[1:] = (sym[1:] != sym[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(head)
    end = np.append(start[1:], len(sym))
    name = sym[start].copy()
    long = np.flatnonzero(end - start > 1)
    name[long] = combine(mix(name[long] + np.uint64(2 * level + 1)),
                         (end - start)[long].astype(np.uint64))
    return start, end, np.cumsum(head) - 1, name


def window_signatures(sym: np.ndarray, row: np.ndarray, width: int = WIDTH):
    """(first symbol, signature, anchor) of every window inside one row."""
    n = len(sym)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    first = np.flatnonzero(row[:n - width + 1] == row[width - 1:])
    sig = np.zeros(len(first), np.uint64)
    anchor = np.zeros(len(first), np.uint64)
    who = np.arange(len(first))
    lo, hi = first.copy(), first + width
    left = np.full(len(first), 1, np.uint64)
    right = np.full(len(first), 2, np.uint64)
    best = np.zeros(len(first), np.uint64)

    def finish(done, core):
        s = combine(combine(left[done], right[done]), core)
        sig[who[done]] = s
        anchor[who[done]] = np.where(best[done] == 0, s, best[done])

    def anchored(best, sym, lo, hi):
        return np.where((hi - lo >= 2) | (best == 0), run_hash(sym, lo, hi), best)

    level = 0
    while len(who):
        start, end, run, name = _renamed(sym, row, level)
        a, b = run[lo], run[hi - 1]
        one = a == b                                    # a window inside one run
        if one.any():
            finish(one, combine(sym[lo[one]], (hi - lo)[one].astype(np.uint64)))
        left = combine(combine(left, sym[lo]), (end[a] - lo).astype(np.uint64))
        right = combine(combine(right, sym[hi - 1]), (hi - start[b]).astype(np.uint64))
        lo, hi = a + 1, b
        empty = ~one & (lo >= hi)
        if empty.any():
            finish(empty, np.full(int(empty.sum()), 3 + 4 * level, np.uint64))
        go = ~one & ~empty
        who, lo, hi, left, right, best = who[go], lo[go], hi[go], left[go], right[go], best[go]
        row = row[start]
        sym = name
        if not len(who):
            break
        is_left = (mix(sym + np.uint64(7919 * (level + 1))) & np.uint64(1)).astype(bool)
        best = anchored(best, sym, lo, hi)
        pop = ~is_left[lo]                              # may close a pair begun outside
        left = np.where(pop, combine(left, sym[lo]), left)
        lo = lo + pop
        ok = lo < hi
        pop = ok & is_left[hi - 1]                      # may open a pair closed outside
        right = np.where(pop, combine(right, sym[hi - 1]), right)
        hi = hi - pop
        empty = lo >= hi
        if empty.any():
            finish(empty, np.full(int(empty.sum()), 5 + 4 * level, np.uint64))
            go = ~empty
            who, lo, hi, left, right, best = who[go], lo[go], hi[go], left[go], right[go], best[go]
        head = np.zeros(len(sym), bool)                 # first symbol of a pair
        head[:-1] = is_left[:-1] & ~is_left[1:] & (row[1:] == row[:-1])
        second = np.zeros(len(sym), bool)
        second[1:] = head[:-1]
        at = np.cumsum(~second) - 1
        joined = sym.copy()
        h = np.flatnonzero(head)
        joined[h] = combine(mix(sym[h] + np.uint64(2 * level + 2)), sym[h + 1])
        sym, row = joined[~second], row[~second]
        if len(who):
            lo, hi = at[lo], at[hi - 1] + 1
            best = anchored(best, sym, lo, hi)
        level += 1
    return first, sig, anchor


class _Parsed(rp.Windows):
    def __init__(self, t: Texts, width: int):
        start, end, row = word_bounds(t.data, t.offsets)
        sym = word_hashes(t.data, start, end)
        first, self.sig, anchor = window_signatures(sym, row, width)
        base = np.searchsorted(row, np.arange(len(t)), side="left")   # first word of a row
        place = np.cumsum(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else anchor
        super().__init__(row[first], first - base[row[first]], anchor, place)


def _run_index(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _run_keys(t, w, first, count):
    sig = w.sig[_run_index(first, count)]
    at = np.arange(len(sig)) - np.repeat(np.cumsum(count) - count, count)
    folded = mix(sig + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.add.reduceat(folded, np.cumsum(count) - count)


def _run_payload(t, w, first, count) -> bytes:
    return w.sig[_run_index(first, count)].tobytes()


def _window_keys(t, w, idx):
    return w.sig[idx], w.anchor[idx]


def _flag_windows(bodies, count, ids):
    sig = np.frombuffer(b"".join(bodies), np.uint64)
    doc = np.repeat(ids, count)
    uniq, inverse = np.unique(sig, return_inverse=True)
    lowest = np.full(len(uniq), np.iinfo(np.int64).max)
    np.minimum.at(lowest, inverse, doc)
    return lowest[inverse] < doc


def _cut(t: Texts, row, start, end) -> pa.Table:
    bounds = np.searchsorted(row, np.arange(len(t) + 1))
    text, n_words, n_removed, sha = [], [], [], []
    for i in range(len(t)):
        words = t.raw(i).split()
        j, k = bounds[i], bounds[i + 1]
        gone = int((end[j:k] - start[j:k]).sum())
        kept = words
        if gone:
            keep = np.ones(len(words), bool)
            for s, e in zip(start[j:k], end[j:k]):
                keep[s:e] = False
            kept = list(itertools.compress(words, keep))
        body = b" ".join(kept)
        text.append(body.decode("utf-8"))
        n_words.append(len(words))
        n_removed.append(gone)
        sha.append(hashlib.sha256(body).hexdigest())
    return pa.table({"doc_id": rp.ids_array(t), "text": pa.array(text, pa.string()),
                     "n_words": pa.array(n_words, pa.int64()),
                     "n_removed": pa.array(n_removed, pa.int64()),
                     "kept_sha256": pa.array(sha, pa.string())})


def remove_repeated_words(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
                          text_col: str = "text", plan=None) -> DataFrame:
    """Drop each word covered by a ``width``-word window that also starts in a
    document with a smaller id. Returns ``OUT``: the kept words joined by one
    space, counts and the SHA-256 of the kept text."""
    return rp.remove_repeats(docs, lambda t: _Parsed(t, width), _run_keys, _run_payload, _window_keys,
                             _flag_windows, _cut, OUT, width, plan, id_col, text_col)
