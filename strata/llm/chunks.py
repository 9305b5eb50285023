"""Corpus-wide look-ups by exchange: chunks of documents ask, buckets answer.

A *chunk* is a hash group of whole documents of about ``chunk_bytes``; a
*bucket* owns a slice of a hash space that grows with the corpus
(2**32 values each, one bucket per ``bucket_bytes`` of text). A chunk asks
once for each distinct key it holds -- so a key in a third of all documents
costs a bucket one entry per chunk, not per document -- and gets one packed
answer per bucket. All rounds of an operator read the same hash exchange of
the documents, which Spark reuses inside one plan: texts are shuffled once.

Sizes come from one scan (bytes of text); nothing is collected but that sum.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASK = "bucket int, chunk long, payload binary"
ANSWER = "chunk long, kind int, payload binary"
CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
HOT_CHUNKS = 32


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    got = docs.agg(F.sum(F.octet_length(text_col)).alias("b")).first()
    return int(got["b"] or 0)


class Plan:
    """Chunk and bucket counts of one corpus; a key in more than
    ``hot_chunks`` (at most 254) chunks is hot."""

    def __init__(self, total_bytes: int, chunk_bytes: int = CHUNK_BYTES,
                 bucket_bytes: int = BUCKET_BYTES, hot_chunks: int = HOT_CHUNKS):
        self.hot_chunks = hot_chunks
        self.chunks = max(1, math.ceil(total_bytes / chunk_bytes))
        self.buckets = max(1, math.ceil(total_bytes / bucket_bytes))


def chunked(docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(chunk, doc_id, text); only these columns travel. Rows without an id
    are spread by their text."""
    key = (F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col).cast("string")))
           .otherwise(F.xxhash64(F.col(id_col).cast("long"))))
    return docs.select(
        F.pmod(key, F.lit(plan.chunks)).cast("long").alias("chunk"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def spread(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit place of mixed 64-bit keys."""
    hi, lo = keys >> np.uint64(32), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return ((hi * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32), lo


def distinct_places(keys: np.ndarray, buckets: int):
    """Distinct (bucket, place) of ``keys`` in order, and each key's index."""
    b, lo = spread(keys, buckets)
    both = (b.astype(np.uint64) << np.uint64(32)) | lo
    uniq, inverse = np.unique(both, return_inverse=True)
    return (uniq >> np.uint64(32)).astype(np.int32), uniq.astype(np.uint32), inverse


def by_bucket(bucket: np.ndarray):
    """(bucket, from, to) of equal runs in a sorted bucket array."""
    if len(bucket) == 0:
        return []
    cut = np.flatnonzero(np.diff(bucket)) + 1
    lo = np.concatenate(([0], cut))
    hi = np.append(cut, len(bucket))
    return list(zip(bucket[lo].tolist(), lo.tolist(), hi.tolist()))


def ask_table(chunk: int, parts: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"bucket": pa.array([p[0] for p in parts], pa.int32()),
                     "chunk": pa.array([chunk] * len(parts), pa.int64()),
                     "payload": pa.array([p[1] for p in parts], pa.binary())})


def answer_table(kind: int, parts: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"chunk": pa.array([p[0] for p in parts], pa.int64()),
                     "kind": pa.array([kind] * len(parts), pa.int32()),
                     "payload": pa.array([p[1] for p in parts], pa.binary())})


def payloads(table: pa.Table, name: str = "payload") -> list[bytes]:
    return table.column(name).to_pylist()


def ask_places(chunk: int, bucket: np.ndarray, place: np.ndarray) -> pa.Table:
    """One payload of sorted 32-bit places per bucket."""
    return ask_table(chunk, [(b, place[i:j].tobytes()) for b, i, j in by_bucket(bucket)])


def answer_counts(kind: int, clip: int):
    """Bucket side: how many chunks ask for each place (``clip`` at most).

    ``kind`` tags the answer; a payload is the bucket (int32), then one byte
    per asked place in the order asked."""
    def answer(table):
        asks = sorted(zip(table.column("chunk").to_pylist(), payloads(table)))
        bucket = table.column("bucket")[0].as_py()
        arrays = [np.frombuffer(p, dtype=np.uint32) for _, p in asks]
        every = np.concatenate(arrays)
        uniq, counts = np.unique(every, return_counts=True)
        counts = np.minimum(counts, clip).astype(np.uint8)
        head = np.int32(bucket).tobytes()
        return answer_table(kind, [(c, head + counts[np.searchsorted(uniq, a)].tobytes())
                                   for (c, _), a in zip(asks, arrays)])
    return answer


def answered(table: pa.Table, kind: int, bucket: np.ndarray) -> np.ndarray:
    """Counts for this chunk's distinct places, joined from all answers."""
    got = {}
    for k, p in zip(table.column("kind").to_pylist(), payloads(table)):
        if k == kind:
            got[int(np.frombuffer(p, dtype=np.int32, count=1)[0])] = p
    parts = [np.frombuffer(got[b], dtype=np.uint8, offset=4) for b, _, _ in by_bucket(bucket)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)
