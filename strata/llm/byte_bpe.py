"""Byte-level BPE encoding and decoding through a sentencepiece model.

``sentencepiece_model`` writes a BPE model file image straight from a rank
vocabulary: piece i is token i with each byte mapped to one printable
character, its score is -i, the normaliser is the identity and an unknown
piece follows the vocabulary. A sentencepiece BPE joins the best-scored
neighbouring pair that is a piece, leftmost first -- the merge rule of the
rank files -- so piece ids are the ranks. A pre-token that is itself a token
is that token (the rank rule for tokens no merge reaches).

Texts are cut into pre-tokens by the pattern given with the vocabulary. A
pre-token never reaches from one run of white space into the next, so a text
is first cut at white space and each distinct piece is handled once per task
(the memo is emptied when it takes ``MEMO_BYTES`` and at the end of a task; it
never changes results).

Defined cases: null text is empty; an empty text has no ids; repeated rows
are encoded alike; null ids pass through; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# White space of the vocabulary's pattern (Unicode White_Space, fixed values).
WHITE = "\t-\r \x85\xa0  -     　"
MEMO_BYTES = 80_000_000
OUT_IDS = "doc_id long, ids array<int>"
OUT_BYTES = "doc_id long, decoded binary"
OUT_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def byte_characters() -> list[str]:
    """One printable character per byte: visible Latin-1 characters stand for
    themselves, the other bytes get characters from U+0100 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for b in range(256):
        if b in visible:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _int(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _blob(field: int, b: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(b)) + b


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """Serialised model: pieces (field 1), trainer (2) and normaliser (3)."""
    chars = byte_characters()
    size = max(ranks.values()) + 1
    token = {r: "".join(chars[b] for b in t) for t, r in ranks.items()}
    normal, unknown, unused = 1, 2, 5
    out = []
    for i in range(size):
        piece, kind = (token[i], normal) if i in token else (f"<unused{i}>", unused)
        out.append(_blob(1, _blob(1, piece.encode()) + b"\x15" + struct.pack("<f", -float(i))
                         + _int(3, kind)))
    out.append(_blob(1, _blob(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _int(3, unknown)))
    bpe = 2
    trainer = _int(3, bpe) + _int(4, size + 1) + _int(40, size) + b"".join(_int(f, -1) for f in (41, 42, 43))
    normaliser = _blob(1, b"identity") + b"".join(_int(f, 0) for f in (3, 4, 5))
    return b"".join(out) + _blob(2, trainer) + _blob(3, normaliser)


class Codec:
    """Encoder and decoder of one vocabulary; made once per worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece
        self.ranks = read_ranks(path)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            tokens[r] = t
        self._lengths = np.array([len(t) for t in tokens], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self._chars = dict(enumerate(byte_characters()))
        self._pattern = regex.compile(pattern)
        self._cut = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self._held = 0                               # bytes of the memo, about
        self._ids: dict[str, bytes] = {}             # piece -> int32 ids
        self._decimal = [str(i) for i in range(max(self.ranks.values()) + 2)]

    def _encode_new(self, pieces: list[str]) -> None:
        """Memorise the ids of new pieces; the model gets all their unknown
        pre-tokens in one call."""
        grams = list(map(self._pattern.findall, pieces))
        flat = {m for g in grams for m in g}
        known, todo = {}, []
        for m in flat:
            r = self.ranks.get(m.encode("utf-8"))
            if r is None:
                todo.append(m)
            else:
                known[m] = struct.pack("<i", r)
        if todo:
            spelled = [m.encode("utf-8").decode("latin-1").translate(self._chars) for m in todo]
            for m, ids in zip(todo, self.model.encode(spelled, num_threads=1)):
                known[m] = array("i", ids).tobytes()
        for p, g in zip(pieces, grams):
            ids = known[g[0]] if len(g) == 1 else b"".join(map(known.__getitem__, g))
            self._ids[p] = ids
            self._held += 200 + 2 * len(p) + len(ids)

    def _pieces(self, texts: list[str]) -> list[list[str]]:
        if self._held > MEMO_BYTES:
            self.forget()
        cut = [self._cut.findall(t) for t in texts]
        new = [p for p in set().union(*cut) if p not in self._ids]
        if new:
            self._encode_new(new)
        return cut

    def forget(self) -> None:
        self._ids.clear()
        self._held = 0

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """int32 ids of each text."""
        get = self._ids.__getitem__
        return [np.frombuffer(b"".join(map(get, c)), np.int32) for c in self._pieces(texts)]

    def encode_with_decimals(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """Ids of each text, also written in decimal and joined by commas."""
        name = self._decimal.__getitem__
        return [(ids, ",".join(map(name, ids.tolist()))) for ids in self.encode_batch(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids' tokens in order (inverse mapping)."""
        size = self._lengths[ids]
        total = int(size.sum())
        at = np.repeat(self._starts[ids] - (np.cumsum(size) - size), size)
        at += np.arange(total)
        return self._bytes[at].tobytes()


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    gc.set_threshold(200_000)              # the memos hold no cycles: look for garbage rarely
    return Codec(path, pattern)


def _groups(texts: list[str], most: int = 4_000_000):
    """Consecutive texts of about ``most`` characters together."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _mapped(docs: DataFrame, id_col: str, text_col: str, make, schema: str, path: str, pattern: str) -> DataFrame:
    from pyspark.sql import functions as F
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in _groups(texts):
                yield make(ids.slice(lo, hi - lo), texts[lo:hi])
        codec(path, pattern).forget()                      # the worker outlives the task
    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text."""
    def make(ids, texts):
        return pa.record_batch({"doc_id": ids, "ids": pa.array(
            codec(path, pattern).encode_batch(texts), pa.list_(pa.int32()))})
    return _mapped(docs, id_col, text_col, make, OUT_IDS, path, pattern)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded) from (doc_id, ids); null ids give empty bytes."""
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column(0), "decoded": pa.array(
                [c.decode(np.array(i or (), np.int64)) for i in batch.column(1).to_pylist()], pa.binary())})
    return encoded.select("doc_id", "ids").mapInArrow(run, OUT_BYTES)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode, decode the ids, and return digests of both (``OUT_DIGEST``);
    ids and bytes stay in the task."""
    def make(ids, texts):
        c = codec(path, pattern)
        got = c.encode_with_decimals(texts)
        return pa.record_batch({
            "doc_id": ids,
            "n_tokens": pa.array([len(g) for g, _ in got], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in got]),
            "decoded_sha256": pa.array([hashlib.sha256(c.decode(g)).hexdigest() for g, _ in got])})
    return _mapped(docs, id_col, text_col, make, OUT_DIGEST, path, pattern)
