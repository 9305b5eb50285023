"""Mixing sources to target weights, in blocks, by DataFrame operations only.

Words ([^\\x20\\x09-\\x0D]+) of a source's documents, in a fixed pseudorandom
document order, form one stream cut into blocks of ``block_words`` words. The
mix is a sequence of *slots*, ``shard_slots`` per output shard; every slot
takes one block of one source.

1. Targets: the sources share ``growth`` times all words by weight (weights
   repeat 3, 1, 2 over the sources by code point, null last); none gets more
   than ``most`` times its words, the excess is shared by weight again. In
   closed form this is min(most * words, level * weight) for one level.
2. Draws: each slot draws its source with probability proportional to the
   source's slots, from a hash of the slot number, so the counts of a shard
   are multinomial and any task can redo any slot. The totals then differ
   from the targets by chance; surplus slots (a source's last ones) are
   passed to the sources that got too few, so totals are exact.
3. A source's j-th slot is in pass j div blocks; within a pass the blocks
   come in a pseudorandom order given by a swap-or-not permutation keyed by
   source and pass (any size, no table), the short last block last. A source
   wanting a part of a pass stops inside its last block, so the words taken
   equal the target, rounded; no block is taken twice in one pass.
4. Slots and blocks are joined by (source, block).

Nothing is random between runs: hashes of ids and slot numbers decide. Running
totals (document starts, slot numbers) are two-level sums over hash buckets,
so no source is summed in one task.

Defined cases: null or empty text has size 0 and is never taken; null sources
are one source; a source without words has target 0; rows with a null doc_id
are placed by their text; repeated rows are separate documents; other columns
stay untouched; an empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
GROWTH = 1.5
MOST = 2
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
ROWS_PER_BUCKET = 512
ROUNDS = 24
_KEY = ["doc_id", "source", "th"]


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(doc_id, source, th, size): th hashes the text."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(source_col).cast("string").alias("source"),
                       F.xxhash64(text).alias("th"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def _before(rows: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over smaller ``order`` in the same ``keys``.

    ``order`` is unique per key; sums of 4,096 consecutive orders first, so
    neither level has a long window partition."""
    group = F.floor(F.col(order) / 4096).alias("grp")
    outer = Window.partitionBy(*keys).orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy(*keys, "grp").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("grp", group)
    base = rows.groupBy(*keys, "grp").agg(F.sum(value).alias("gs")) \
        .withColumn("gb", F.coalesce(F.sum("gs").over(outer), F.lit(0))).drop("gs")
    cond = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "grp"]]
    joined = rows.alias("r").join(base.alias("b"), cond).select("r.*", "b.gb")
    return joined.withColumn(out, F.col("gb") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("grp", "gb")


def source_targets(sizes: DataFrame, weights=WEIGHTS, growth: float = GROWTH, most: int = MOST,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: s (its number), words, target, and its slots:
    full blocks, blocks per pass, words wanted, slots."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    # One row per source: these windows run over the list of sources only.
    rows = (sizes.groupBy("source").agg(F.sum("size").alias("words"))
            .withColumn("s", F.row_number().over(by_name) - 1)
            .withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                          (F.col("s") % len(weights) + 1).cast("int")))
            .withColumn("cap", F.col("words") * float(most)))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "s")
    lower = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    upper = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.sum("words").over(whole) * float(growth)
    rows = (rows.withColumn("level", (total - F.coalesce(F.sum("cap").over(lower), F.lit(0.0)))
                            / F.sum("w").over(upper))
            .withColumn("fits", F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))))
    level = F.max("fits").over(whole)
    b = block_words
    return (rows.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("w"), F.col("cap"))))
            .withColumn("full", F.floor(F.col("words") / b))
            .withColumn("blocks", F.ceil(F.col("words") / b))
            .withColumn("want", F.least(F.floor(F.col("target") + 0.5), F.col("words") * most))
            .withColumn("passes", F.when(F.col("words") > 0, F.floor(F.col("want") / F.col("words"))).otherwise(0))
            .withColumn("slots", (F.col("passes") * F.col("blocks")
                                  + F.ceil((F.col("want") - F.col("passes") * F.col("words")) / b)).cast("long"))
            .select("source", "s", "words", "target", "full", "blocks", "want", "slots"))


def permuted(i: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Image of i under a swap-or-not permutation of 0..n-1 (n > 0): each
    round pairs x with k - x (mod n) and swaps a pair by a hash bit."""
    def step(x, r):
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        bit = F.xxhash64(key, r, F.greatest(x, other)) % 2
        return F.when(bit != 0, other).otherwise(x)
    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), i.cast("long"), step)


def slots_of(sources: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS,
             shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, slot, s, pass, block, take): the mix as block references."""
    spark = sources.sparkSession
    total = sources.agg(F.sum("slots")).first()[0] or 0
    whole = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    src = sources.withColumn("lo", F.coalesce(F.sum("slots").over(whole), F.lit(0)))
    # The draw picks the source whose range of 0..total-1 holds a hash of the
    # slot; ranges are cut into equal cells so that this is an equi-join.
    cell = max(1, math.ceil(total / 4096))
    cells = (src.filter("slots > 0")
             .select("s", "lo", (F.col("lo") + F.col("slots")).alias("hi"),
                     F.explode(F.sequence(F.floor(F.col("lo") / cell),
                                          F.floor((F.col("lo") + F.col("slots") - 1) / cell))).alias("cell")))
    drawn = (spark.range(total).withColumnRenamed("id", "slot")
             .withColumn("v", F.pmod(F.xxhash64(F.lit(seed), "slot"), F.lit(max(total, 1))))
             .withColumn("cell", F.floor(F.col("v") / cell))
             .join(cells, "cell").filter("v >= lo AND v < hi")
             .select(F.floor(F.col("slot") / shard_slots).alias("shard"), "slot", "s"))
    counts = materialize(drawn.groupBy("s", "shard").agg(F.count(F.lit(1)).alias("c")), "mix-counts")
    start = _before(counts, ["s"], "shard", "c", "start").select("s", "shard", "start")
    in_shard = Window.partitionBy("s", "shard").orderBy("slot")
    numbered = (drawn.withColumn("k", F.row_number().over(in_shard) - 1).join(start, ["s", "shard"])
                .select("shard", "slot", "s", (F.col("start") + F.col("k")).alias("j")))
    got = counts.groupBy("s").agg(F.sum("c").alias("got"))
    spare = (src.join(got, "s", "left").withColumn("got", F.coalesce("got", F.lit(0)))
             .withColumn("over", F.greatest(F.col("got") - F.col("slots"), F.lit(0)))
             .withColumn("under", F.greatest(F.col("slots") - F.col("got"), F.lit(0)))
             .withColumn("over_at", F.coalesce(F.sum("over").over(whole), F.lit(0)))
             .withColumn("under_at", F.coalesce(F.sum("under").over(whole), F.lit(0))))
    holes = (spare.filter("under > 0")
             .select(F.col("s").alias("s2"), "got", F.posexplode(F.sequence(
                 F.col("under_at"), F.col("under_at") + F.col("under") - 1)).alias("n", "q"))
             .select("q", "s2", (F.col("got") + F.col("n")).alias("j2")))
    placed = (numbered.join(spare.select("s", "slots", "over_at"), "s")
              .withColumn("q", F.when(F.col("j") >= F.col("slots"), F.col("over_at") + F.col("j") - F.col("slots")))
              .join(holes, "q", "left")
              .select("shard", "slot", F.coalesce("s2", "s").alias("s"), F.coalesce("j2", "j").alias("j")))
    at = placed.join(src.select("s", "words", "full", "blocks", "want"), "s") \
        .withColumn("pass", F.floor(F.col("j") / F.col("blocks"))) \
        .withColumn("i", F.col("j") - F.col("pass") * F.col("blocks"))
    key = F.xxhash64(F.lit(seed), F.col("s"), F.col("pass"))
    done = F.col("pass") * F.col("words") + F.col("i") * block_words
    return (at.withColumn("block", F.when(F.col("i") < F.col("full"), permuted(F.col("i"), F.col("full"), key))
                          .otherwise(F.col("i")))
            .withColumn("take", F.least(F.lit(block_words), F.col("words") - F.col("i") * block_words,
                                        F.col("want") - done))
            .select("shard", "slot", "s", "pass", "block", "take"))


def document_blocks(sizes: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS,
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per document and block it reaches into (one with a null block
    for a document without words): document columns, at (its place in the
    source's stream), block, a and z (its part of the block), first (number
    of its word at a)."""
    buckets = max(1, math.ceil(sizes.count() / rows_per_bucket))
    h = F.when(F.col("doc_id").isNull(), F.col("th")).otherwise(F.xxhash64("doc_id"))
    rows = sizes.join(sources.select("source", "s", "words", "target").withColumnRenamed("source", "src"),
                      F.col("source").eqNullSafe(F.col("src"))).drop("src") \
        .withColumn("bucket", F.pmod(h, F.lit(buckets)))
    per = rows.groupBy("s", "bucket").agg(F.sum("size").alias("b"))
    base = _before(per, ["s"], "bucket", "b", "base").select("s", "bucket", "base")
    inside = (Window.partitionBy("s", "bucket").orderBy("doc_id", "th", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    copies = Window.partitionBy("s", "bucket", "doc_id", "th").orderBy("size")
    placed = (rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .withColumn("copy", F.row_number().over(copies))
              .join(base, ["s", "bucket"]).withColumn("at", F.col("base") + F.col("inner")))
    b = block_words
    reach = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("at") / b),
                                                 F.floor((F.col("at") + F.col("size") - 1) / b)))
    return (placed.select(*_KEY, "copy", "size", "s", "words", "target", "at", F.explode_outer(reach).alias("block"))
            .withColumn("a", F.greatest(F.col("at") - F.col("block") * b, F.lit(0)))
            .withColumn("z", F.least(F.col("at") + F.col("size") - F.col("block") * b, F.lit(b)))
            .withColumn("first", F.col("block") * b + F.col("a") - F.col("at")))


def _prepared(docs, id_col, text_col, source_col, seed, block_words, shard_slots):
    sizes = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
    sources = materialize(source_targets(sizes, block_words=block_words), "mix-sources")
    slots = slots_of(sources, seed, block_words, shard_slots)
    return sizes, sources, slots, document_blocks(sizes, sources, block_words)


def mixed_blocks(docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS,
                 shard_slots: int = SHARD_SLOTS, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source") -> DataFrame:
    """The mix: (shard, slot, source, pass, block, n_words, pieces), pieces
    naming the words: doc_id, th (hash of the text), first word, words."""
    _, sources, slots, blocks = _prepared(docs, id_col, text_col, source_col, seed, block_words, shard_slots)
    parts = blocks.filter("block IS NOT NULL").select("s", "block", "a", "z", "first", "doc_id", "th")
    inside = F.least("z", "take") - F.col("a")
    return (slots.join(parts, ["s", "block"]).filter(inside > 0)
            .groupBy("shard", "slot", "s", "pass", "block", "take")
            .agg(F.array_sort(F.collect_list(F.struct("a", "doc_id", "th", "first", inside.alias("n"))))
                 .alias("pieces"))
            .join(sources.select("s", "source"), "s")
            .select("shard", "slot", "source", "pass", "block", F.col("take").alias("n_words"), "pieces"))


def mixed_words(docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS,
                shard_slots: int = SHARD_SLOTS, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's), taken
    (words of it in the mix, repeats counted)."""
    _, _, slots, blocks = _prepared(docs, id_col, text_col, source_col, seed, block_words, shard_slots)
    times = slots.groupBy("s", "block", "take").agg(F.count(F.lit(1)).alias("times"))
    part = F.greatest(F.least("z", "take") - F.col("a"), F.lit(0)) * F.col("times")
    return (blocks.join(times, ["s", "block"], "left")
            .groupBy(*_KEY, "copy", "size", "words", "target", "at")
            .agg(F.coalesce(F.sum(part), F.lit(0)).cast("long").alias("taken"))
            .select("doc_id", "size", F.col("words").alias("source_size"), "target", "taken"))


def mixed_documents(docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS,
                    shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix as documents (columns of ``docs``: doc_id, text, source,
    n_chars and others): one row per document and pass that takes words of
    it. A document taken whole keeps its text; of a document taken in part
    the taken words stay, in order, joined by one space."""
    _, _, slots, blocks = _prepared(docs, "doc_id", "text", "source", seed, block_words, shard_slots)
    inside = F.least("z", "take") - F.col("a")
    parts = (blocks.filter("block IS NOT NULL").join(slots.select("s", "block", "pass", "take"), ["s", "block"])
             .filter(inside > 0)
             .groupBy(*_KEY, "copy", "size", "pass")
             .agg(F.array_sort(F.collect_list(F.struct("first", inside.alias("n")))).alias("pieces"),
                  F.sum(inside).alias("got")))
    # identical rows are told apart by a number; which is which does not matter
    same = Window.partitionBy("doc_id", "source", "__th").orderBy(F.lit(1))
    text = docs.withColumn("__th", F.xxhash64(F.col("text").cast("string"))) \
        .withColumn("__copy", F.row_number().over(same))
    cond = [F.col(f"d.{a}").eqNullSafe(F.col(f"p.{b}"))
            for a, b in (("doc_id", "doc_id"), ("source", "source"), ("__th", "th"), ("__copy", "copy"))]
    words = F.regexp_extract_all(F.col("d.text"), F.lit(f"({WORD})"), F.lit(1))
    cut = F.array_join(F.flatten(F.transform(
        "p.pieces", lambda x: F.slice(words, (x["first"] + 1).cast("int"), x["n"].cast("int")))), " ")
    new_text = F.when(F.col("p.got") == F.col("p.size"), F.col("d.text")).otherwise(cut)
    out = text.alias("d").join(parts.alias("p"), cond)
    keep = [new_text.alias("text") if c == "text"
            else F.length(new_text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"d.`{c}`") for c in docs.columns]
    return out.select(*keep)
