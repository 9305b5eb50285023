"""Numpy views of many texts at once: bytes, words, rolling hashes.

Texts of a group of documents are handled as one byte buffer with document
offsets (the layout Arrow already uses), so the per-document Python cost is
small and every step is an array operation.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space bytes of the word pattern [^\x20\x09-\x0D]+ (fixed values).
SPACE_BYTES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACE_BYTES)] = True

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_MUL1 = _U(0xBF58476D1CE4E5B9)
_MUL2 = _U(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x += _ODD
    x ^= x >> _U(30)
    x *= _MUL1
    x ^= x >> _U(27)
    x *= _MUL2
    x ^= x >> _U(31)
    return x


def combine(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Order-dependent combination of two hash arrays."""
    out = (h ^ (x * _MUL2 + _ODD)) * _MUL1
    out ^= out >> _U(29)
    return out


_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64))


@functools.lru_cache(maxsize=2)
def _powers_upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)
    return run(_BASE), run(_BASE_INV)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, int(n - 1).bit_length()) if n > 1 else 1 << 20
    return _powers_upto(size)


class Texts:
    """Documents of one group in a fixed order: ids, byte buffer, offsets.

    Rows are ordered by (doc_id, text) with null ids last, so the order does
    not depend on how rows arrived. A null text counts as the empty text.
    """

    def __init__(self, table: pa.Table, id_col: str = "doc_id", text_col: str = "text"):
        ids = table.column(id_col).combine_chunks()
        text = table.column(text_col).combine_chunks()
        if isinstance(ids, pa.ChunkedArray):
            ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.array([], ids.type)
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], text.type)
        text = text.cast(pa.large_binary()) if len(text) else pa.array([], pa.large_binary())
        valid = np.asarray(pc.is_valid(ids)) if len(ids) else np.zeros(0, bool)
        num = np.asarray(pc.fill_null(ids, 0).cast(pa.int64())) if len(ids) else np.zeros(0, np.int64)
        order = np.lexsort((num, ~valid))
        same = np.flatnonzero((num[order][1:] == num[order][:-1]) & (valid[order][1:] == valid[order][:-1]))
        if len(same):                      # repeated ids: the text decides
            order = np.array(sorted(order.tolist(), key=lambda i: (
                not valid[i], int(num[i]), text[i].as_py() or b"")), dtype=np.int64)
        text = pc.fill_null(text, b"").take(pa.array(order)) if len(order) else text
        self.order = order
        self.ids = num[order]
        self.valid = valid[order]
        n = len(text)
        if n:
            bufs = text.buffers()
            off = np.frombuffer(bufs[1], dtype=np.int64, count=n + 1, offset=8 * text.offset)
            raw = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] else np.zeros(0, np.uint8)
            self.data = raw[off[0]:off[-1]]
            self.offsets = off - off[0]
        else:
            self.data = np.zeros(0, np.uint8)
            self.offsets = np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.ids)

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased (nothing else changes)."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] |= 32
    return out


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; see ``slice_hash``."""
    p = np.empty(len(data) + 1, dtype=np.uint64)
    p[0] = 0
    if len(data):
        np.cumsum(_BYTE_HASH[data] * _powers(len(data) + 1)[0][:len(data)], out=p[1:])
    return p


def slice_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte slices [start, end), independent of their place."""
    inv = _powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64) * _ODD)


def run_hash(sym: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of symbol runs [start, end), independent of their place."""
    power, inv = _powers(len(sym) + 1)
    p = np.zeros(len(sym) + 1, dtype=np.uint64)
    np.cumsum(mix(sym) * power[:len(sym)], out=p[1:])
    return mix((p[end] - p[start]) * inv[start])


def word_bounds(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of words [^\\x20\\x09-\\x0D]+ and the row each lies in.

    Words never cross documents."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~_SPACE[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    first = offsets[:-1]
    before[first[first < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, row


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return slice_hash(prefix_hash(data), starts, ends)


def merge_spans(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of [start, end) per row: sorted, maximal, disjoint spans."""
    if len(row) == 0:
        return row, start, end
    o = np.lexsort((start, row))
    row, start, end = row[o], start[o], end[o]
    # running maximum of ends inside a row: shift rows apart, then accumulate
    width = int(end.max()) + 2
    far = np.maximum.accumulate(end + row * width)
    new = np.ones(len(row), bool)
    new[1:] = (start[1:] + row[1:] * width) > far[:-1]
    cut = np.flatnonzero(new)
    stop = np.append(cut[1:], len(row)) - 1
    return row[cut], start[cut], far[stop] - row[cut] * width
