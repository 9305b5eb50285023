"""Passage removal by longest-previous-factor arrays (windows of bytes).

Anchors: the smallest hashed ``SEED``-byte gram of each window (a minimizer).
Equal windows have the same minimizer, so all copies of a window meet in the
minimizer's bucket; consecutive windows with one minimizer travel together as
one text of at most ``2 * width`` bytes. Windows of a minimizer that over
``HOT_CHUNKS`` chunks hold are compared by two 64-bit hashes of their halves
instead.

In a bucket the texts are concatenated and their suffixes that start a window
sorted (up to the window length, ties by document). For every suffix the
previous and the next entry of the suffix array with a smaller document are
found with the least common prefix on the way; the larger of the two prefixes
is the suffix's longest previous factor, cut to the window length (prefixes
shorter than the window count as none). A window whose factor reaches the
window length also starts in an earlier document and is removed; the copy in
the smallest document stays.

Defined cases: null text is empty; documents shorter than the window lose
nothing; rows with a null doc_id keep everything and do not count as earlier
copies; rows sharing a doc_id do not remove each other's bytes; other columns
are ignored. Removal may cut a UTF-8 character; kept bytes are returned as
binary.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import chunks as ch
from strata.llm import repeats as rp
from strata.llm.textarrays import Texts, prefix_hash, slice_hash

WIDTH = 50
SEED = 24
HOT_CHUNKS = 254                       # the most that a one-byte count tells from "more"
PACK = "zstd", 1                       # of the runs' text: Spark's own lz4 codes no letters
OUT = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _sliding_min(key: np.ndarray, span: int) -> np.ndarray:
    """Minimum of key[i:i+span] for every i that has a full span."""
    have = 1
    cur = key
    while have * 2 <= span:
        cur = np.minimum(cur[:-have], cur[have:])
        have *= 2
    rest = span - have
    return np.minimum(cur[:len(cur) - rest], cur[rest:]) if rest else cur


class _Minimizers(rp.Windows):
    def __init__(self, t: Texts, width: int, seed: int):
        n = len(t.data)
        self.prefix = prefix_hash(t.data)
        length = np.diff(t.offsets)
        if n < width:
            z = np.zeros(0, np.int64)
            super().__init__(z, z, np.zeros(0, np.uint64), z)
            return
        at = np.arange(n - seed + 1)
        gram = slice_hash(self.prefix, at, at + seed)
        key = (gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
        low = _sliding_min(key, width - seed + 1)
        many = np.maximum(length - width + 1, 0)
        row = np.repeat(np.arange(len(t)), many)
        begin = np.repeat(t.offsets[:-1], many)
        start = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        place = (low[begin + start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        super().__init__(row, start, gram[place], place)


def _ends(t, w, first, count, width):
    begin = t.offsets[:-1][w.row[first]] + w.start[first]
    return begin, begin + count + (width - 1)


def suffix_ranks(text: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """Order ranks of the suffixes of ``text`` that start at ``at`` (all, if not
    given), cut to ``width`` bytes (equal ranks: equal cut suffixes). ``text``
    must end in ``width`` pads.

    Sorted by their first bytes; then only suffixes that are still tied are
    sorted by as many more as fit beside their rank in 64 bits."""
    n = len(text)
    at = np.arange(n) if at is None else at
    padded = np.concatenate([text, np.zeros(width + 8, np.uint8)])
    # the eight bytes from every position on, most significant first
    words = np.ndarray((n + width,), ">u8", padded, strides=(1,))
    rank = np.zeros(len(at), np.int64)                  # entries that sort before
    tied = np.arange(len(at))
    have = 0
    while have < width and len(tied):
        old = rank[tied]
        take = min((64 - int(old.max()).bit_length()) // 8, width - have)
        key = words[at[tied] + have].astype(np.uint64) >> np.uint64(64 - 8 * take)
        if have:
            key |= old.astype(np.uint64) << np.uint64(8 * take)
        order = np.argsort(key)
        tied, key, old = tied[order], key[order], old[order]
        head = np.ones(len(key), bool)
        head[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(key)))
        outer = np.ones(len(key), bool)
        outer[1:] = old[1:] != old[:-1]
        start = np.flatnonzero(outer)[np.cumsum(outer) - 1]
        rank[tied] = np.repeat(old[first] + first - start[first], size)
        tied = tied[np.repeat(size > 1, size)]
        have += take
    return rank


def _previous_smaller(doc: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each entry the common prefix with the nearest earlier entry that
    has a smaller document (0 if none); lcp[i]: entries i-1 and i.

    All entries between an entry and its link have a document that is not
    smaller, so a link may jump over its target's own link; links at least
    double in reach each round."""
    n = len(doc)
    link = np.arange(-1, n - 1)
    least = lcp.copy()
    todo = np.arange(n)
    while len(todo):
        to = link[todo]
        todo = todo[(to >= 0) & (doc[to] >= doc[todo])]
        todo = todo[least[todo] > 0]                    # nothing in common any more
        to = link[todo]
        new_least = np.minimum(least[todo], least[to])
        new_link = link[to]
        link[todo], least[todo] = new_link, new_least
    return np.where(link >= 0, least, 0)


def longest_previous_factor(order_doc: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """LPF in suffix order: the longer common prefix with the previous and the
    next entry of a smaller document. lcp[0] must be 0."""
    back = _previous_smaller(order_doc, lcp)
    turned = np.zeros(len(lcp), lcp.dtype)
    turned[1:] = lcp[1:][::-1]
    ahead = _previous_smaller(order_doc[::-1], turned)[::-1]
    return np.maximum(back, ahead)


def _packed(body: bytes) -> bytes:
    """Size and compressed bytes; size 0 and the bytes themselves if that is shorter."""
    small = pa.Codec(PACK[0], PACK[1]).compress(body, asbytes=True)
    return np.uint32(len(body)).tobytes() + small if len(small) < len(body) else np.uint32(0).tobytes() + body


def _unpacked(packed: bytes) -> bytes:
    size, body = int(np.frombuffer(packed, np.uint32, 1)[0]), packed[4:]
    return pa.Codec(PACK[0]).decompress(body, size, asbytes=True) if size else body


def _flag_windows(width: int):
    def flag(bodies, count, ids):
        data = np.frombuffer(b"".join(map(_unpacked, bodies)), np.uint8)
        size = count + (width - 1)
        begin = np.cumsum(size) - size
        h = slice_hash(prefix_hash(data), begin, begin + size)
        # equal texts: only the smallest document's copy enters the array
        o = np.lexsort((ids, h))
        head = np.ones(len(o), bool)
        head[1:] = h[o][1:] != h[o][:-1]
        firsts = o[np.flatnonzero(head)]
        group = np.empty(len(o), np.int64)
        group[o] = np.cumsum(head) - 1
        many, fsize = count[firsts], size[firsts]
        take = np.repeat(begin[firsts] - (np.cumsum(fsize) - fsize), fsize) + np.arange(int(fsize.sum()))
        text = np.concatenate([data[take], np.zeros(width, np.uint8)])
        fbegin = np.cumsum(fsize) - fsize
        pos = np.repeat(fbegin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        doc = np.repeat(ids[firsts], many)
        rank = suffix_ranks(text, width, pos)
        sa = np.lexsort((doc, rank))                    # suffix array of window starts
        lcp = np.zeros(len(sa), np.int64)
        r = rank[sa]
        same = np.flatnonzero(r[1:] == r[:-1]) + 1
        lcp[same] = width
        # Only factors of full length matter; shorter prefixes count as none.
        lpf = np.empty(len(sa), np.int64)
        lpf[sa] = longest_previous_factor(doc[sa], lcp)
        first_flags = lpf >= width
        # spread to all runs: in a later document every window has a copy
        fstart = np.cumsum(many) - many
        src = np.repeat(fstart[group] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        later = ids > ids[firsts][group]
        return first_flags[src] | np.repeat(later, count)
    return flag


def _cut(t: Texts, row, start, end) -> pa.Table:
    bounds = np.searchsorted(row, np.arange(len(t) + 1))
    kept, gone, sha = [], [], []
    for i in range(len(t)):
        raw = t.raw(i)
        j, k = bounds[i], bounds[i + 1]
        if k > j:
            cuts = np.stack([np.append(0, end[j:k]), np.append(start[j:k], len(raw))], 1)
            body = b"".join(raw[a:b] for a, b in cuts.tolist())
        else:
            body = raw
        kept.append(body)
        gone.append(len(raw) - len(body))
        sha.append(hashlib.sha256(body).hexdigest())
    return pa.table({"doc_id": rp.ids_array(t), "kept": pa.array(kept, pa.binary()),
                     "n_bytes": pa.array(np.diff(t.offsets), pa.int64()),
                     "n_removed": pa.array(gone, pa.int64()),
                     "n_spans": pa.array(np.diff(bounds), pa.int64()),
                     "kept_sha256": pa.array(sha, pa.string())})


def remove_repeated_bytes(docs: DataFrame, width: int = WIDTH, seed: int = SEED,
                          id_col: str = "doc_id", text_col: str = "text", plan=None) -> DataFrame:
    """Drop each byte covered by a ``width``-byte string that also starts in a
    document with a smaller id. Returns ``OUT``."""
    def windows(t):
        return _Minimizers(t, width, seed)

    def keys(t, w, first, count):
        return slice_hash(w.prefix, *_ends(t, w, first, count, width))

    def payload(t, w, first, count):
        b, e = _ends(t, w, first, count, width)
        size = e - b
        at = np.repeat(b - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return _packed(t.data[at].tobytes())

    def window_keys(t, w, idx):
        b = t.offsets[:-1][w.row[idx]] + w.start[idx]
        return slice_hash(w.prefix, b, b + width // 2), slice_hash(w.prefix, b + width // 2, b + width)

    plan = plan or ch.Plan(ch.text_bytes(docs, text_col), hot_chunks=HOT_CHUNKS)
    return rp.remove_repeats(docs, windows, keys, payload, window_keys, _flag_windows(width), _cut,
                             OUT, width, plan, id_col, text_col)
