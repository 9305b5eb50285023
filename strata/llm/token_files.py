"""Token-id files: concatenated ids with Elias-Fano document boundaries.

Documents are range-partitioned by (doc_id, hash of text); each task encodes
its documents in order and writes files of about ``file_ids`` ids to a shared
folder. A file holds a header, the Elias-Fano code of its document boundaries,
the Elias-Fano code of its document ids, and one array of ids (16 bits when
the vocabulary allows, 32 otherwise). A file is written under a name of its
attempt and then renamed, and its final name and content depend on the data
alone, so a repeated task leaves the same files.

``read_token_files`` reads the files back with Spark and returns every
document with its start among all ids: file headers carry the ids before the
file in its partition, and the partition totals (one row each) are summed.

Texts are encoded with the tokenizers library, white-space words once per
task: the vocabulary's pattern drops white space, so ids of a text are the ids
of its words in order. Words of Latin-1 characters are normalised and cut here
and only the merges are run by the library; all other words take the library's
whole path. With ``special_ids`` the literal strings of the vocabulary's added
tokens become their ids, as the library does by default: texts are cut at them
first. Otherwise these strings are ordinary text.

Defined cases: null text is empty (only the end id); rows with a null doc_id
come last; rows sharing a doc_id are ordered by the hash of their text; no
documents give no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import gc
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.byte_bpe import byte_characters
from strata.llm.elias_fano import EliasFano
from strata.session import ensure_checkpoint_dir, materialize

MAGIC = b"EFTOKEN1"
# id bytes, partition, file number, documents, documents with an id, ids, ids before, least doc_id
_HEAD = struct.Struct("<8sBxxxIIQQQQq")
FILE_IDS = 2_000_000
END_ID = 2
MEMO = 800_000
MANIFEST = "part int, file int, n_docs long, n_ids long, path string"
OUT = "part int, before long, at long, doc_id long, n_tokens long, ids binary, ids_crc32 long"


class _Memo(dict):
    """Remembers what ``make`` gives for a string; emptied when it is large."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, key: str) -> bytes:
        if len(self) > MEMO:
            self.clear()
        got = self[key] = self._make(key)
        return got


class WordEncoder:
    """Ids of whole texts from the ids of their words, as little-endian
    unsigned integers of ``width`` bytes."""

    def __init__(self, path: str, width: int = 4, special_ids: bool = False):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_ids
        # The vocabulary's pre-token pattern, on text without white space.
        self._pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self._space = re.compile("[^\t-\r ]+")
        self._chars = dict(enumerate(byte_characters()))
        self._code = {2: "H", 4: "I"}[width]
        self._words = _Memo(self._word)
        self._grams = _Memo(self._gram)
        self._special = self._whole = None
        added = self.tokenizer.get_added_tokens_decoder() if special_ids else {}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values()):
            # matched on normalised text or with their surroundings: not cut here
            self._whole = True
        elif added:
            longest = sorted((t.content for t in added.values()), key=len, reverse=True)
            self._special = re.compile("(" + "|".join(map(re.escape, longest)) + ")")
            self._special_id = {t.content: self._ids([i]) for i, t in added.items()}

    def _ids(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self._code}", *ids)

    def _gram(self, g: str) -> bytes:
        spelled = g.encode("utf-8").decode("latin-1").translate(self._chars)
        return self._ids([t.id for t in self.tokenizer.model.tokenize(spelled)])

    def _word(self, w: str) -> bytes:
        if w.isascii() or (max(w) < "Ā" and "\x85" not in w and "\xa0" not in w):
            return b"".join(map(self._grams.__getitem__, self._pattern.findall(w.lower())))
        return self._ids(self.tokenizer.encode(w, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if self._whole:
            return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self._special is not None and self._special.search(text):
            parts = self._special.split(text)           # the odd ones are added tokens
            return b"".join(self._special_id[p] if k % 2 else self._plain(p) for k, p in enumerate(parts))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._words.__getitem__, self._space.findall(text)))


@functools.lru_cache(maxsize=2)
def _encoder(path: str, width: int, special_ids: bool) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    gc.set_threshold(200_000)              # the memos hold no cycles: look for garbage rarely
    return WordEncoder(path, width, special_ids)


def _file_system(uri: str):
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def file_image(part: int, number: int, before: int, doc_ids: list, ids: list[bytes], width: int) -> bytes:
    """One file's bytes; ``ids`` in the file's width, null doc_ids last."""
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    bounds = np.concatenate(([0], np.cumsum([len(i) // width for i in ids], dtype=np.int64)))
    head = _HEAD.pack(MAGIC, width, part, number, len(doc_ids), len(known), int(bounds[-1]), before, least)
    return b"".join([head, EliasFano.of(bounds).to_bytes(),
                     EliasFano.of(np.array(known, np.int64) - least).to_bytes(), *ids])


class TokenFile:
    """One file read back."""

    def __init__(self, data: bytes):
        (magic, self.width, self.part, self.number, self.n_docs, known, self.n_ids, self.before,
         least) = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.bounds, at = EliasFano.from_bytes(data, _HEAD.size)
        ids, at = EliasFano.from_bytes(data, at)
        self.doc_ids = (ids.values() + least).tolist() + [None] * (self.n_docs - known)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)

    def document(self, i: int) -> np.ndarray:
        """Ids of document i, found by select."""
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None,
                      end_id: int = END_ID, vocabulary_size: int = 49_408,
                      file_ids: int = FILE_IDS, id_col: str = "doc_id",
                      text_col: str = "text", special_ids: bool = False) -> tuple[str, DataFrame]:
    """Encode and write all documents; (folder, manifest with a row per file).

    ``folder`` must be reachable by all executors; unset, a new one in the
    shared checkpoint folder is used. ``special_ids``: the strings of added
    tokens become their ids (the library's default) instead of ordinary text."""
    spark = docs.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    fs, path = _file_system(folder)
    fs.create_dir(path, recursive=True)
    width = 2 if max(vocabulary_size, end_id + 1) <= 1 << 16 else 4
    key = [F.col("doc_id").asc_nulls_last(), F.col("h")]
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
            .withColumn("h", F.xxhash64("text")).repartitionByRange(*key)
            .sortWithinPartitions(*key).select("doc_id", "text"))

    def write(batches):
        part = TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()
        out_fs, out_path = _file_system(folder)
        state = {"file": 0, "before": 0}
        doc_ids: list = []
        ids: list = []
        size = 0

        def flush():
            name = f"part-{part:06d}-{state['file']:06d}.ids"
            image = file_image(part, state["file"], state["before"], doc_ids, ids, width)
            temp = f"{out_path}/.{name}.{attempt}"
            with out_fs.open_output_stream(temp) as f:
                f.write(image)
            out_fs.move(temp, f"{out_path}/{name}")
            row = pa.record_batch({
                "part": pa.array([part], pa.int32()), "file": pa.array([state["file"]], pa.int32()),
                "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([size], pa.int64()),
                "path": pa.array([f"{folder}/{name}"])})
            state["file"] += 1
            state["before"] += size
            return row

        enc = _encoder(tokenizer_path, width, special_ids)
        end = end_id.to_bytes(width, "little")
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_ids.append(d)
                ids.append(enc.encode(t or "") + end)
                size += len(ids[-1]) // width
                if size >= file_ids:
                    yield flush()
                    doc_ids, ids, size = [], [], 0
        if doc_ids:
            yield flush()

    return folder, materialize(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(folder: str, manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the
    files. ``ids``: little-endian unsigned 32-bit integers."""
    spark = manifest.sparkSession
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.ids")
             .schema("path string, modificationTime timestamp, length long, content binary")
             .load(folder).select("content"))

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                f = TokenFile(batch.column(0)[k].as_py())
                at = f.bounds.values()
                for lo in range(0, f.n_docs, 4096):
                    hi = min(lo + 4096, f.n_docs)
                    raw = [f.ids[at[i]:at[i + 1]].astype("<u4").tobytes() for i in range(lo, hi)]
                    n = hi - lo
                    yield pa.record_batch({
                        "part": pa.array([f.part] * n, pa.int32()),
                        "before": pa.array([f.before] * n, pa.int64()),
                        "at": pa.array(at[lo:hi], pa.int64()),
                        "doc_id": pa.array(f.doc_ids[lo:hi], pa.int64()),
                        "n_tokens": pa.array(np.diff(at[lo:hi + 1]), pa.int64()),
                        "ids": pa.array(raw if with_ids else [None] * n, pa.binary()),
                        "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64())})

    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition of the writer
    base = totals.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    rows = files.mapInArrow(read, OUT).join(F.broadcast(base), "part")
    out = rows.select("doc_id", (F.col("base") + F.col("before") + F.col("at")).alias("start"),
                      "n_tokens", "ids_crc32", "ids")
    return out if with_ids else out.drop("ids")
