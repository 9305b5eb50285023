"""Shared parts of the two passage-removal operators (bytes and words).

Both look for windows of fixed length that also start in a document with a
smaller id. They differ in how windows get anchors and how equal windows are
recognised; the exchange is the same:

1. every chunk asks which of its distinct anchors other chunks hold too;
2. windows whose anchor is shared go to the anchor's bucket as *runs*
   (consecutive windows with one anchor occurrence); a bucket decides which
   windows also start in a smaller document and answers with spans.
   An anchor that more than ``hot_chunks`` chunks hold is *hot*: runs at the
   edges of a wide-spread passage reach into each document's own text, so one
   bucket would get a run of every document. Its windows go one by one to
   buckets of their own, spread by two 64-bit keys of the window's content
   and at most once per chunk and document id (whether an anchor is hot is the
   same in all chunks, so all copies of a window go the same way);
3. every chunk cuts the spans out of its documents.

Inside a chunk equal runs are sent once, for the smallest document holding
them: in the other documents of the chunk every such window has an earlier
copy already, so their spans go straight to step 3.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import chunks as ch
from strata.llm.textarrays import Texts, combine, merge_spans, mix

SEEN, SPANS = 1, 2
_LOCAL = -1


class Windows:
    """Valid windows of one chunk, in text order.

    row: document row; start: first unit; anchor: 64-bit anchor hash;
    place: identity of the anchor's occurrence (equal for consecutive
    windows that hold the same occurrence)."""

    def __init__(self, row, start, anchor, place):
        self.row, self.start, self.anchor, self.place = row, start, anchor, place


def _anchor_places(w: Windows, buckets: int):
    """Distinct (bucket, place) of the anchors, the first window of each stretch
    of windows with one anchor and row, the stretches' places and lengths."""
    new = np.ones(len(w.anchor), bool)
    new[1:] = (w.anchor[1:] != w.anchor[:-1]) | (w.row[1:] != w.row[:-1])
    head = np.flatnonzero(new)
    bucket, place, inverse = ch.distinct_places(mix(w.anchor[head]), buckets)
    return bucket, place, head, inverse, np.diff(np.append(head, len(new)))


def ask_anchors(windows_of: Callable[[Texts], Windows], buckets: int):
    def ask(key, table):
        w = windows_of(Texts(table))
        bucket, place, *_ = _anchor_places(w, buckets)
        return ch.ask_places(key[0].as_py(), bucket, place)
    return ask


def runs_of(w: Windows, keep: np.ndarray):
    """First window and window count of each run of kept windows."""
    idx = np.flatnonzero(keep)
    if len(idx) == 0:
        return idx, idx
    new = np.ones(len(idx), bool)
    new[1:] = ((idx[1:] != idx[:-1] + 1) | (w.place[idx[1:]] != w.place[idx[:-1]])
               | (w.row[idx[1:]] != w.row[idx[:-1]]))
    cut = np.flatnonzero(new)
    return idx[cut], np.diff(np.append(cut, len(idx)))


def span_payload(row, start, end) -> bytes:
    return np.stack([row, start, end]).astype(np.int64).tobytes()


def _group_low(ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Smallest id among the entries with the same two keys, per entry."""
    order = np.lexsort((ids, two, one))
    head = np.ones(len(order), bool)
    head[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    low = np.empty(len(ids), np.int64)
    low[order] = ids[order[np.flatnonzero(head)]][np.cumsum(head) - 1]
    return low


def _ask_hot(t: Texts, w: Windows, idx: np.ndarray, window_keys, buckets: int, width: int):
    """Windows of hot anchors: payloads per window bucket and local spans."""
    one, two = window_keys(t, w, idx)
    row, start = w.row[idx], w.start[idx]
    ids = t.ids[row]
    later = ids > _group_low(ids, one, two)
    parts = []
    if later.any():
        spans = merge_spans(row[later], start[later], start[later] + width)
        parts.append((_LOCAL, span_payload(*spans)))
    sent = np.flatnonzero(~later)
    b, _ = ch.spread(mix(combine(one[sent], two[sent])), buckets)
    o = np.argsort(b, kind="stable")
    sent, b = sent[o], b[o]
    for bk, i, j in ch.by_bucket(b):
        pick = sent[i:j]
        parts.append((buckets + bk, np.int64(len(pick)).tobytes() + one[pick].tobytes() + two[pick].tobytes()
                      + ids[pick].tobytes() + np.stack([row[pick], start[pick]]).astype(np.uint32).tobytes()))
    return parts


def _answer_hot(asks, width: int):
    """Bucket side of ``_ask_hot``: spans of windows with a copy in a smaller document."""
    ones, twos, ids, places = [], [], [], []
    for _, p in asks:
        n = int(np.frombuffer(p, np.int64, 1)[0])
        ones.append(np.frombuffer(p, np.uint64, n, offset=8))
        twos.append(np.frombuffer(p, np.uint64, n, offset=8 + 8 * n))
        ids.append(np.frombuffer(p, np.int64, n, offset=8 + 16 * n))
        places.append(np.frombuffer(p, np.uint32, 2 * n, offset=8 + 24 * n).reshape(2, n).astype(np.int64))
    every = np.concatenate(ids)
    later = every > _group_low(every, np.concatenate(ones), np.concatenate(twos))
    parts, at = [], 0
    for (chunk, _), (row, start) in zip(asks, places):
        hit = later[at:at + len(row)]
        at += len(row)
        if hit.any():
            parts.append((chunk, span_payload(*merge_spans(row[hit], start[hit], start[hit] + width))))
    return ch.answer_table(SPANS, parts)


def ask_runs(windows_of, run_keys, run_payload, window_keys, buckets: int, width: int,
             hot_chunks: int = ch.HOT_CHUNKS):
    """Second round: runs of windows whose anchors are shared.

    ``run_keys(texts, w, first, count)`` -> 64-bit content hash per run;
    ``run_payload(texts, w, first, count)`` -> content bytes of chosen runs;
    ``window_keys(texts, w, index)`` -> two 64-bit content keys per window."""
    def ask(key, docs, answers):
        if docs.num_rows == 0:
            return ch.ask_table(0, [])
        chunk = key[0].as_py()
        t = Texts(docs)
        w = windows_of(t)
        bucket, _, head, inverse, size = _anchor_places(w, buckets)
        holders = ch.answered(answers, SEEN, bucket)
        shared = holders > 1
        # documents of this chunk that share an anchor among themselves
        if len(inverse):
            low = np.full(len(bucket), len(t), np.int64)
            high = np.full(len(bucket), -1, np.int64)
            np.minimum.at(low, inverse, w.row[head])
            np.maximum.at(high, inverse, w.row[head])
            shared |= high > low
        keep = np.repeat(shared[inverse], size) & t.valid[w.row] if len(inverse) else np.zeros(0, bool)
        parts = []
        if len(inverse):
            hot = keep & np.repeat((holders > hot_chunks)[inverse], size)
            if hot.any():
                parts = _ask_hot(t, w, np.flatnonzero(hot), window_keys, buckets, width)
                keep = keep & ~hot
        first, count = runs_of(w, keep)
        if len(first) == 0:
            return ch.ask_table(chunk, parts)
        content = combine(run_keys(t, w, first, count), w.anchor[first])
        row = w.row[first]
        order = np.lexsort((row, content))              # rows are in id order
        head = np.ones(len(order), bool)
        head[1:] = content[order][1:] != content[order][:-1]
        lowest = order[np.flatnonzero(head)][np.cumsum(head) - 1]
        later = np.zeros(len(first), bool)
        later[order] = t.ids[row[order]] > t.ids[row[lowest]]
        if later.any():
            s = w.start[first[later]]
            spans = merge_spans(row[later], s, s + count[later] + (width - 1))
            parts.append((_LOCAL, span_payload(*spans)))
        sent = np.flatnonzero(~later)
        b, _ = ch.spread(mix(w.anchor[first[sent]]), buckets)
        o = np.argsort(b, kind="stable")
        sent, b = sent[o], b[o]
        for bk, i, j in ch.by_bucket(b):
            pick = sent[i:j]
            head = np.stack([row[pick], w.start[first[pick]], count[pick]]).astype(np.uint32)
            body = run_payload(t, w, first[pick], count[pick])
            parts.append((bk, np.int64(len(pick)).tobytes() + t.ids[row[pick]].tobytes() + head.tobytes() + body))
        return ch.ask_table(chunk, parts)
    return ask


def answer_runs(flag_windows, buckets: int, width: int):
    """Bucket side of round two.

    ``flag_windows(bodies, counts, ids)`` -> one flag per window, True when
    the window also starts in a document with a smaller id."""
    def answer(table):
        if table.column("bucket")[0].as_py() == _LOCAL:
            return ch.answer_table(SPANS, list(zip(table.column("chunk").to_pylist(), ch.payloads(table))))
        asks = sorted(zip(table.column("chunk").to_pylist(), ch.payloads(table)))
        if table.column("bucket")[0].as_py() >= buckets:
            return _answer_hot(asks, width)
        heads, ids, bodies = [], [], []
        for _, p in asks:
            n = int(np.frombuffer(p, np.int64, 1)[0])
            ids.append(np.frombuffer(p, np.int64, n, offset=8))
            heads.append(np.frombuffer(p, np.uint32, 3 * n, offset=8 + 8 * n).reshape(3, n))
            bodies.append(p[8 + 20 * n:])
        owner = np.repeat(np.arange(len(asks)), [h.shape[1] for h in heads])
        ids = np.concatenate(ids)
        row, start, count = np.concatenate(heads, axis=1).astype(np.int64)
        flags = flag_windows(bodies, count, ids)
        run = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        hit = np.flatnonzero(flags)
        parts = []
        if len(hit):
            r = run[hit]
            s = start[r] + at[hit]
            who = owner[r]
            for c in range(len(asks)):
                m = slice(*np.searchsorted(who, [c, c + 1]))
                if m.start < m.stop:
                    spans = merge_spans(row[r[m]], s[m], s[m] + width)
                    parts.append((asks[c][0], span_payload(*spans)))
        return ch.answer_table(SPANS, parts)
    return answer


def spans_of(answers: pa.Table):
    """All removed spans of a chunk, merged: (row, start, end)."""
    got = [np.frombuffer(p, np.int64).reshape(3, -1) for p in ch.payloads(answers)]
    if not got:
        z = np.zeros(0, np.int64)
        return z, z, z
    return merge_spans(*np.concatenate(got, axis=1))


def remove_repeats(docs: DataFrame, windows_of, run_keys, run_payload, window_keys, flag_windows, cut,
                   out_schema: str, width: int, plan: ch.Plan | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Run the three rounds; ``cut(texts, row, start, end)`` builds the output."""
    plan = plan or ch.Plan(ch.text_bytes(docs, text_col))
    rows = ch.chunked(docs, plan, id_col, text_col)
    asks = rows.groupBy("chunk").applyInArrow(ask_anchors(windows_of, plan.buckets), ch.ASK)
    seen = asks.groupBy("bucket").applyInArrow(ch.answer_counts(SEEN, 255), ch.ANSWER)
    runs = rows.groupBy("chunk").cogroup(seen.groupBy("chunk")).applyInArrow(
        ask_runs(windows_of, run_keys, run_payload, window_keys, plan.buckets, width, plan.hot_chunks), ch.ASK)
    # local spans are spread over the chunks, not gathered in one bucket
    spans = (runs.withColumn("own", F.when(F.col("bucket") < 0, F.col("chunk")).otherwise(F.lit(0)))
             .groupBy("bucket", "own").applyInArrow(answer_runs(flag_windows, plan.buckets, width), ch.ANSWER))

    def finish(key, left, answers):
        t = Texts(left)
        return cut(t, *spans_of(answers))

    return rows.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(finish, out_schema)


def ids_array(t: Texts) -> pa.Array:
    return pa.array(t.ids, pa.int64(), mask=~t.valid)
