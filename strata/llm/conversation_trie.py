"""Prefix trie of conversations, built from adaptive radix trees.

A turn (role, text) is named by a fixed-width id, the first 16 bytes of its
SHA-256; a conversation is the string of its turns' ids, which are big-endian,
so strings sort as sequences do. Texts are read once, to make ids and word
counts; only ids travel.

Equal sequences are merged first (their members' ids are hashed as a sorted
stream, one row at a time). The distinct sequences are range-partitioned and
sorted; a task inserts one run of them at a time into a radix tree
(``radix_tree``) and emits a trie node for every depth of whole turns, inside
compressed paths too. Depths that are no multiple of the id's width emit none.

A node whose sequences all lie inside a run is complete there. Only the nodes
on the paths of a run's first and last sequence can continue in other runs;
they leave the task with what their complete children add up to, and are
merged by a digest of their path. What these open nodes pass on to their
ancestors is summed by doubling: after k rounds a node holds the sums over its
open descendants less than 2^k levels below. So no task holds more than a run,
and no conversation, first turn or group of copies makes one task large.

Defined cases: rows without a conv_id take no part; null role or text is
empty; turns are ordered by turn (null first), then by role and text in code
point order; repeated rows are repeated turns; a conversation may be empty
after rebuilding and is then a member of the root only; an empty table gives
no nodes; other columns are not read. Limits: the ids of one conversation (48
bytes a turn while it is sorted) fit a task, and so does the one conversation
that a run holds at least; the digest of a node's members is one stream.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.radix_tree import RadixTree
from strata.llm.stages import written
from strata.session import materialize

WIDTH = 16
RUN_KEYS = 20_000
RUN_BYTES = 16_000_000
SALTS = 16
WORD = r"[^\x20\x09-\x0D]+"
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
MEMBERS = "seq string, least long, n long, ends string"
NODES = ("open boolean, digest binary, parent binary, conv_id long, depth long, parent_conv_id long, n long, "
         "kids long, leaves long, saved long, words long, ends string")


def turn_ids(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, turn, tie, id, words): ``tie`` orders different turns of one
    conversation that share a turn number."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    base = (turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                         role.alias("role"), text.alias("text")).filter("conv_id IS NOT NULL")
            .withColumn("id", F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
                                                 .cast("binary"), 256), 1, 2 * WIDTH)))
    named = written(base.select("conv_id", "turn", "id", F.regexp_count("text", F.lit(WORD)).alias("words")), "turns")
    ties = (named.groupBy("conv_id", "turn").agg(F.min("id").alias("a"), F.max("id").alias("z"))
            .filter("a <> z").select("conv_id", "turn"))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    t = ties.toDF("c", "t")
    order = (base.join(t, (base["conv_id"] == t["c"]) & base["turn"].eqNullSafe(t["t"]), "left_semi")
             .withColumn("tie", F.dense_rank().over(same)).select("conv_id", "turn", "id", "tie").distinct())
    if order.isEmpty():
        return named.withColumn("tie", F.lit(0))
    o = materialize(order, "ties").toDF("c", "t", "i", "tie")
    return named.join(o, (named["conv_id"] == o["c"]) & named["turn"].eqNullSafe(o["t"]) & (named["id"] == o["i"]),
                      "left").select(*named.columns, F.coalesce("tie", F.lit(0)).alias("tie"))


def sequences(named: DataFrame) -> DataFrame:
    """(conv_id, turns in order) of every conversation."""
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "tie", "id", "words")
    return named.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")) \
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words")))
                .alias("turns"))


def with_shared_heads(convs: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Conversation c begins with the first h turns of c - c % every, h being
    crc32(c) % (most + 1), and goes on with its own turns after its first h."""
    conv = F.col("conv_id")
    heads = convs.filter(conv % every == 0).select(conv.alias("head_id"), F.slice("turns", 1, most).alias("head"))
    h = (F.crc32(conv.cast("string").cast("binary")) % (most + 1)).cast("int")
    none = F.slice("turns", 1, 0)
    return (convs.join(heads, conv - conv % every == F.col("head_id"), "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                                        F.slice("turns", h + 1, F.size("turns"))).alias("turns")))


def _members(batches):
    """Digest of each sequence's members, from rows sorted by (seq, conv_id)."""
    seq, least, n, stream = None, 0, 0, None
    for batch in batches:
        out = []
        for s, c in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
            if s != seq:
                if seq is not None:
                    out.append((seq, least, n, stream.hexdigest()))
                seq, least, n, stream = s, c, 1, hashlib.sha256(str(c).encode())
            else:
                n += 1
                stream.update(b"," + str(c).encode())
        yield _batch(out, MEMBERS)
    if seq is not None:
        yield _batch([(seq, least, n, stream.hexdigest())], MEMBERS)


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(cols, fields)],
                                      [n for n, _ in fields])


class Frame:
    """A radix node on the way down: what its finished children add up to."""

    __slots__ = ("node", "above", "end", "kids", "n", "least", "low", "high", "leaves", "saved", "waiting")

    def __init__(self, node, above: int):
        self.node, self.above = node, above
        self.end = above + len(node.path)
        self.kids = iter(node.children())
        self.n, self.least, self.low, self.high = 0, None, None, None
        self.leaves = self.saved = 0
        self.waiting: list[list] = []              # complete nodes whose parent is further up

    def add(self, n, least, low, high):
        self.n += n
        self.least = least if self.least is None else min(self.least, least)
        self.low = low if self.low is None else min(self.low, low)
        self.high = high if self.high is None else max(self.high, high)


def _path_digests(key: bytes, width: int) -> list[bytes]:
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for at in range(0, len(key), width):
        h.update(key[at:at + width])
        out.append(h.copy().digest())
    return out


def run_nodes(run: list[tuple], width: int = WIDTH) -> list[list]:
    """Rows of ``NODES`` of one run: tuples (key, words per turn, n, least
    member, members' digest) with distinct keys in ascending order."""
    tree = RadixTree()
    for i, row in enumerate(run):
        tree.insert(row[0], i)
    ends = {0: _path_digests(run[0][0], width), len(run) - 1: _path_digests(run[-1][0], width)}
    out: list[list] = []
    frames = [Frame(tree.root, 0)]
    while frames:
        f = frames[-1]
        step = next(f.kids, None)
        if step is not None:
            frames.append(Frame(step[1], f.end + 1))
            continue
        frames.pop()
        i = f.node.value
        if i is not None:
            f.add(run[i][2], run[i][3], i, i)
        # whole turns between the byte that leads here and the end of the path
        first = 0 if not frames else -(-f.above // width)
        for depth in range(f.end // width, first - 1, -1):
            whole = depth * width
            words = run[f.low][1][depth - 1] if depth else 0
            members = run[i][4] if i is not None and whole == f.end else NO_MEMBERS
            at = 0 if f.low == 0 else len(run) - 1 if f.high == len(run) - 1 else None
            own = (f.n - 1) * words
            if at is None:
                f.leaves = f.leaves if f.waiting else 1
                f.saved += own
                row = [False, None, None, f.least, depth, None, f.n, len(f.waiting), f.leaves, f.saved, words, members]
                for w in f.waiting:
                    w[5] = f.least
                f.waiting = [row]
            else:
                digest = ends[at][depth]
                row = [True, digest, ends[at][depth - 1] if depth else None, f.least, depth, None, f.n,
                       len(f.waiting), f.leaves, f.saved, words, members]
                for w in f.waiting:
                    w[2] = digest
                f.leaves, f.saved, f.waiting = 0, 0, []
            out.append(row)
        if frames:
            up = frames[-1]
            up.add(f.n, f.least, f.low, f.high)
            up.leaves += f.leaves
            up.saved += f.saved
            up.waiting += f.waiting
    return out


def _trees(run_keys: int, run_bytes: int, width: int):
    def task(batches):
        run, held = [], 0
        for batch in batches:
            cols = [batch.column(c) for c in ("key", "words", "n", "least", "ends")]
            for row in zip(*(c.to_pylist() for c in cols)):
                if run and (len(run) >= run_keys or held + len(row[0]) > run_bytes):
                    yield _batch(run_nodes(run, width), NODES)
                    run, held = [], 0
                run.append(row)
                held += len(row[0])
        if run:
            yield _batch(run_nodes(run, width), NODES)
    return task


def _merged(nodes: DataFrame) -> DataFrame:
    """The open nodes, merged, with the sums over their whole subtrees."""
    parts = nodes.filter("open").groupBy("digest").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n"), F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.max("words").alias("words"),
        F.max(F.when(F.col("ends") != NO_MEMBERS, F.col("ends"))).alias("ends"))
    more = parts.groupBy("parent").agg(F.count(F.lit(1)).alias("open_kids")).withColumnRenamed("parent", "digest")
    full = materialize(
        parts.join(more, "digest", "left").withColumn("kids", F.col("kids") + F.coalesce("open_kids", F.lit(0)))
        .withColumn("leaves", F.col("leaves") + (F.col("kids") == 0).cast("long"))
        .withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("words")).drop("open_kids"), "open")
    sums = full.select("digest", F.col("parent").alias("above"), "leaves", "saved")
    levels = (full.agg(F.max("depth")).first()[0] or 0) + 1
    reach = 1
    while reach < levels:
        below = sums.filter("above IS NOT NULL").groupBy("above").agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")).toDF("digest", "ml", "ms")
        further = sums.select(F.col("digest").alias("above"), F.col("above").alias("further"))
        sums = materialize(
            sums.join(below, "digest", "left").join(further, "above", "left")
            .select("digest", F.col("further").alias("above"),
                    (F.col("leaves") + F.coalesce("ml", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("ms", F.lit(0))).alias("saved")), "sums")
        reach *= 2
    return materialize(full.drop("leaves", "saved").join(sums.drop("above"), "digest"), "open")


def trie_nodes(convs: DataFrame, run_keys: int = RUN_KEYS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The trie of (conv_id, turns of (id, words)): one row per node."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    convs = written(convs.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"].cast("int"))
                                 .alias("words"), F.sha2(key, 256).alias("seq")), "sequences")
    members = (convs.select("seq", "conv_id").repartition("seq").sortWithinPartitions("seq", "conv_id")
               .mapInArrow(_members, MEMBERS))
    distinct = (members.withColumn("conv_id", F.col("least"))
                .join(convs.select("conv_id", "key", "words"), "conv_id")
                .select("key", "words", "n", "least", "ends"))
    nodes = written(distinct.repartitionByRange("key").sortWithinPartitions("key")
                    .mapInArrow(_trees(run_keys, run_bytes, WIDTH), NODES), "nodes")
    merged = _merged(nodes)
    cols = ["conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_MEMBERS)).alias("ends_sha256")]
    above = merged.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    complete = nodes.filter("NOT open")
    inside = complete.filter("parent IS NULL").select(*cols)
    below = (complete.filter("parent IS NOT NULL").drop("parent_conv_id")
             .withColumn("salt", F.pmod("conv_id", F.lit(SALTS)).cast("int"))
             .join(above.select("*", salt), ["parent", "salt"]).select(*cols))
    return inside.union(below).union(merged.join(above, "parent", "left").select(*cols))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", every: int = 20, most: int = 3, **runs) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    named = turn_ids(turns, conv_col, turn_col, role_col, text_col)
    return trie_nodes(with_shared_heads(sequences(named), every, most), **runs)
