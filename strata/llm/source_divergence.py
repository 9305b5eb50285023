"""Audit of how far the sources of a language diverge, over a frequent-pattern tree.

Terms are runs of ASCII letters, of which A-Z are lower-cased, and of other
characters beyond ASCII. A language
keeps the terms found in at least ``min_docs`` of its documents (rows). A group
(language, source), and the language as a whole, gives a kept term the scaled
probability ``p = 1 + floor(SCALE * (count + 1) / (N + V))``; the divergence of
p from q at a term is ``f = floor((p - q)^2 / q)``. All arithmetic is on whole
numbers.

The sum of f over all V terms of a pair of sources (s, t) is split, with p0 the
value of a term that does not occur, into

    V f(p0s, p0t)
    + sum over terms in s    of f(ps, p0t) - f(p0s, p0t)
    + sum over terms in t    of f(p0s, pt) - f(p0s, p0t)
    + sum over terms in both of f(ps, pt) - f(ps, p0t) - f(p0s, pt) + f(p0s, p0t)

The two middle sums need only how often each count occurs in a source. The
last one is the work of the tree: a term is a row of its nonzero (source,
count) items, sources with most terms first; equal rows are counted; rows with
a common beginning share nodes; a node's correction with each of its ancestors
is made once and multiplied by the number of terms that pass through it.

Rows are dealt to tasks by ranges of their items and sorted, so rows with a
common beginning are neighbours; a task builds the tree of one run of rows at
a time. A node cut in two by a run's end only has its multiplicity in two
parts, which add up. A run holds at most ``RUN_ITEMS`` items (or one row),
whatever the size of a language or source.

Defined cases: null text, lang and source are empty strings; every row is a
document, repeated doc_ids and repeated rows included; a language without kept
terms has pairs of value 0 and no terms; an empty table gives no rows; other
columns are not read. Sums of f must fit 63 bits (they stay below about
``SCALE`` squared), and the word counts of a language 9 * 10^15.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.stages import written

# UTF-8 bytes with A-Z lower-cased and every byte that ends a term made a space
AS_WORDS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
RUN_ITEMS = 400_000
HELD_TERMS = 400_000
BEGINNING = 6                       # items of a row that decide its range
SALTS = 16
CORRECTIONS = "lang string, s int, t int, st long, ts long"


def share(count: str, total: str) -> str:
    """SQL of 1 + floor(SCALE * (count + 1) / total); null where total is 0.
    Where the product could leave 63 bits it is a long division in base 1000."""
    t = f"nullif({total}, 0L)"
    short = f"(({SCALE}L * ({count} + 1L)) div {t})"
    digits, rest = [f"(({count} + 1L) div {t})"], f"(({count} + 1L) % {t})"
    for _ in range(3):
        digits.append(f"(({rest} * 1000L) div {t})")
        rest = f"(({rest} * 1000L) % {t})"
    long = " + ".join(f"{d} * {SCALE // 1000 ** k}L" for k, d in enumerate(digits))
    return f"(1L + CASE WHEN {count} < 9000000000L THEN {short} ELSE {long} END)"


def divergence(p: str, q: str) -> str:
    return f"((({p} - {q}) * ({p} - {q})) div {q})"


def _count_terms(held_terms: int):
    """Task: (lang, source, term, count, in_docs) of its documents; counts
    leave whenever ``held_terms`` terms are held."""
    def rows(counts, docs):
        for (lang, source), terms in counts.items():
            found = docs[lang, source]
            names = list(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(names), pa.string()), pa.array([source] * len(names), pa.string()),
                 pa.array(names, pa.binary()).cast(pa.string()), pa.array(terms.values(), pa.int64()),
                 pa.array([found[w] for w in names], pa.int64())], ["lang", "source", "term", "count", "in_docs"])

    def task(batches):
        counts, docs = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            text = batch.column("text").cast(pa.binary()).to_pylist()
            for raw, lang, source in zip(text, batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
                words = raw.translate(AS_WORDS).split()
                counts[lang, source].update(words)
                docs[lang, source].update(set(words))
            if sum(map(len, counts.values())) >= held_terms:
                yield from rows(counts, docs)
                counts, docs = defaultdict(Counter), defaultdict(Counter)
        yield from rows(counts, docs)

    return task


def term_rows(docs: DataFrame, text_col: str, lang_col: str, source_col: str, min_docs: int,
              held_terms: int = HELD_TERMS) -> DataFrame:
    """(lang, term, lang_count, items of (source, count)) of every kept term.
    Tasks count their own documents first, so a common term or a large source
    ships one row a task; one shuffle by (lang, term) serves both sums."""
    each = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in
                         ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    counts = (each.mapInArrow(_count_terms(held_terms), "lang string, source string, term string, count long, in_docs long")
              .repartition("lang", "term").groupBy("lang", "source", "term")
              .agg(F.sum("count").alias("count"), F.sum("in_docs").alias("in_docs")))
    return (counts.groupBy("lang", "term").agg(F.sum("in_docs").alias("in_docs"), F.sum("count").alias("lang_count"),
                                               F.collect_list(F.struct("source", "count")).alias("items"))
            .filter(F.col("in_docs") >= min_docs).drop("in_docs"))


def group_totals(docs: DataFrame, terms: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """One row per occurring group: its number in the tree's order of sources,
    N of group and language, V, and p of a term that the group lacks."""
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in
                           ((lang_col, "lang"), (source_col, "source")))).distinct()
    sums = (terms.select("lang", F.explode("items").alias("i")).groupBy("lang", "i.source")
            .agg(F.sum("i.count").alias("n"), F.count(F.lit(1)).alias("kinds")))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("lang_n"))
    order = Window.partitionBy("lang").orderBy(F.col("kinds").desc(), "source")
    return (groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
            .fillna(0, ["n", "kinds", "v", "lang_n"])
            .withColumn("rank", F.row_number().over(order))
            .withColumn("p0", F.expr(share("0L", "n + v"))).drop("kinds"))


class PatternTree:
    """The tree of sorted rows: nodes with source number, p, p0, parent and
    the number of terms through them; roots have parent -1."""

    def __init__(self, lang: np.ndarray, times: np.ndarray, starts: np.ndarray, rank: np.ndarray,
                 count: np.ndarray, p: np.ndarray, p0: np.ndarray):
        lengths = np.diff(starts)
        row = np.repeat(np.arange(len(lengths)), lengths)
        at = np.arange(len(rank)) - starts[:-1][row]
        prior = np.minimum(np.where(row > 0, starts[row - 1] + at, 0), max(len(rank) - 1, 0))
        same = (row > 0) & (at < lengths[row - 1]) & (lang[row] == lang[row - 1])
        same &= (rank[prior] == rank) & (count[prior] == count)
        differs = np.minimum.reduceat(np.where(same, len(rank), at), starts[:-1]) if len(rank) else at
        new = at >= differs[row] if len(rank) else same
        # the node of a shared item: the last one made at its place in the row
        by = np.lexsort((row, at))
        made = np.maximum.accumulate(np.where(new[by], np.arange(len(by)), 0))
        number = np.cumsum(new) - 1
        node = np.empty(len(rank), np.int64)
        node[by] = number[by[made]]
        self.lang, self.rank, self.p, self.p0 = lang[row][new], rank[new], p[new], p0[new]
        self.parent = np.where(at[new] > 0, node[np.maximum(np.flatnonzero(new) - 1, 0)], -1)
        self.times = np.zeros(int(new.sum()), np.int64)
        np.add.at(self.times, node, times[row])

    def corrections(self) -> tuple[np.ndarray, ...]:
        """(lang, s, t, sum for s against t, sum for t against s), s being the
        ancestor: one term of the sum per node and ancestor."""
        def f(p, q):
            return (p - q) ** 2 // q

        out = []
        node, above = np.arange(len(self.parent)), self.parent
        while True:
            node, above = node[above >= 0], above[above >= 0]
            if not len(node):
                break
            pt, p0t, ps, p0s, m = self.p[node], self.p0[node], self.p[above], self.p0[above], self.times[node]
            out.append(_summed(self.lang[node], self.rank[above], self.rank[node],
                               m * (f(ps, pt) - f(ps, p0t) - f(p0s, pt) + f(p0s, p0t)),
                               m * (f(pt, ps) - f(pt, p0s) - f(p0t, ps) + f(p0t, p0s))))
            above = self.parent[above]
        return _summed(*(np.concatenate(x) for x in zip(*out))) if out else (np.zeros(0, np.int64),) * 5


def _summed(lang, s, t, st, ts):
    by = np.lexsort((t, s, lang))
    lang, s, t = lang[by], s[by], t[by]
    first = np.ones(len(by), bool)
    first[1:] = (lang[1:] != lang[:-1]) | (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(first)
    return lang[at], s[at], t[at], np.add.reduceat(st[by], at), np.add.reduceat(ts[by], at)


def tree_corrections(rows: DataFrame, run_items: int = RUN_ITEMS) -> DataFrame:
    """Sums over the terms that two sources share, of the distinct rows (lang,
    items of (rank, count, p, p0), times) sorted within their partitions."""
    def one(run: pa.RecordBatch) -> pa.RecordBatch:
        items = run.column("items")
        flat = items.flatten()
        starts = np.concatenate([[0], np.cumsum(np.asarray(items.value_lengths(), np.int64))])
        words = run.column("lang").dictionary_encode()
        lang, s, t, st, ts = PatternTree(
            np.asarray(words.indices, np.int64), np.asarray(run.column("times"), np.int64), starts,
            *(np.asarray(flat.field(c), np.int64) for c in ("rank", "count", "p", "p0"))).corrections()
        return pa.RecordBatch.from_arrays(
            [words.dictionary.take(pa.array(lang)), pa.array(s, pa.int32()), pa.array(t, pa.int32()),
             pa.array(st, pa.int64()), pa.array(ts, pa.int64())], ["lang", "s", "t", "st", "ts"])

    def task(batches):
        for batch in batches:
            ends = np.cumsum(np.asarray(batch.column("items").value_lengths(), np.int64))
            a = 0
            while a < batch.num_rows:
                gone = int(ends[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(ends, gone + run_items, side="right")))
                yield one(batch.slice(a, b - a))
                a = b

    return rows.mapInArrow(task, CORRECTIONS)


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds a group's
    divergence from every other source of its language, part ``term`` the
    ``top_terms`` terms by which a group most exceeds its language."""
    terms = written(term_rows(docs, text_col, lang_col, source_col, min_docs), "terms")
    groups = written(group_totals(docs, terms, lang_col, source_col), "groups")
    items = (terms.select("lang", "term", "lang_count", F.explode("items").alias("i"))
             .select("lang", "term", "lang_count", "i.source", "i.count")
             .join(groups, ["lang", "source"])
             .withColumn("p", F.expr(share("count", "n + v"))))

    over = (items.withColumn("q", F.expr(share("lang_count", "lang_n + v"))).filter("p > q")
            .select("lang", "source", F.col("term").alias("item"), F.expr(divergence("p", "q")).alias("value")))
    rank = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    term_part = over.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top_terms)

    # terms that one source has, against every other source
    seen = (items.groupBy("lang", "rank", "count", "p", "p0").agg(F.count(F.lit(1)).alias("times"))
            .withColumn("salt", F.pmod(F.xxhash64("rank", "count"), F.lit(SALTS)).cast("int")))
    other = groups.select("lang", F.col("rank").alias("other"), F.col("p0").alias("q0"))
    alone = (seen.join(other.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["lang", "salt"])
             .filter("rank <> other").groupBy("lang", "rank", "other")
             .agg(F.expr(f"sum(times * ({divergence('p', 'q0')} - {divergence('p0', 'q0')}))").alias("st"),
                  F.expr(f"sum(times * ({divergence('q0', 'p')} - {divergence('q0', 'p0')}))").alias("ts")))
    # terms that two sources share
    paths = (items.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct(
                F.col("rank").cast("int").alias("rank"), "count", "p", "p0"))).alias("items"))
             .groupBy("lang", "items").agg(F.count(F.lit(1)).alias("times"))
             .repartitionByRange("lang", F.slice(F.transform("items", lambda i: F.struct(i["rank"], i["count"])),
                                                 1, BEGINNING))
             .sortWithinPartitions("lang", "items"))
    both = written(tree_corrections(paths), "corrections")

    def two_ways(d: DataFrame, s: str, t: str) -> DataFrame:
        return d.select("lang", F.explode(F.array(
            F.struct(F.col(s).alias("s"), F.col(t).alias("t"), F.col("st").alias("value")),
            F.struct(F.col(t).alias("s"), F.col(s).alias("t"), F.col("ts").alias("value")))).alias("x")) \
            .select("lang", "x.*")

    shift = two_ways(alone, "rank", "other").union(two_ways(both, "s", "t")) \
        .groupBy("lang", "s", "t").agg(F.sum("value").alias("shift"))
    a = groups.select("lang", "source", "v", "p0", F.col("rank").alias("s"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("rank").alias("t"))
    value = F.coalesce(F.expr(f"v * {divergence('p0', 'q0')}"), F.lit(0)) + F.coalesce("shift", F.lit(0))
    pairs = (a.join(b, "lang").filter("s <> t").join(shift, ["lang", "s", "t"], "left")
             .select("lang", "source", "item", value.cast("long").alias("value")))
    pair_part = pairs.withColumn("rank", F.row_number().over(rank))

    cols = ["lang", "source", "part", "item", "value", "rank"]
    return (pair_part.withColumn("part", F.lit("pair")).select(*cols)
            .union(term_part.withColumn("part", F.lit("term")).select(*cols)))
