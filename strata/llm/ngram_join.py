"""Set-similarity self-join on word n-grams and its classes.

A document's set holds its distinct ``width``-word shingles (A-Z lower-cased,
words [^\\x20\\x09-\\x0D]+); a document of fewer words has its whole word
sequence as one element. Two documents link when
``100 * intersection >= percent * union``.

Method: rare-first prefix filtering.

1. Document frequencies of all shingles by the chunk exchange (``chunks``).
2. A set ordered by (frequency, hash) can only link through its first
   ``n - ceil(t n) + 1`` elements. Elements of frequency one match nothing, so
   a document whose prefix holds only those has no link and is done here.
3. Documents with equal sets become one representative (128-bit set hash).
4. Representatives sharing a prefix element are candidates, at the first
   element they share; length filter,
   positional filter (elements left after the last shared one) and suffix
   filter (elements per hash range) discard pairs; the others are verified
   once by intersecting their sets.
5. Classes are the connected components of verified links.

Large groups of near copies would give all their pairs in step 4. Verified
links already joining two documents make their pair redundant for the class,
so step 4 first runs a *star* round: each prefix element pairs its other
documents with one hub, the text with the fewest elements of its own (the one
the others were copied from). Further rounds with other hubs follow while the
pairs of different classes outnumber the postings by far; then every remaining
pair of different classes is taken. No link between different classes is lost,
and no list is expanded into all pairs of one class.

Hashes are 64 bits for shingles; sets are compared by them.

Defined cases: null or empty text has an empty set, links with nothing and is
its own class; rows with a null doc_id have a null class and take no part;
rows sharing a doc_id are one node (each row shows its own set size); other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import chunks as ch
from strata.llm.components import connected_components
from strata.llm.stages import written
from strata.llm.textarrays import Texts, combine, lower_ascii, mix, word_bounds, word_hashes
from strata.session import materialize

WIDTH = 5
PERCENT = 75
FREQUENCY = 3
STAR_ROUNDS = 2
SETS = ("doc_id long, n long, key1 long, key2 long, candidate boolean, "
        "grams array<long>, places array<int>, elements binary")
_U = np.uint64


class _Sets:
    """Distinct shingle hashes of each document of a chunk, row by row."""

    def __init__(self, t: Texts, width: int):
        start, end, row = word_bounds(t.data, t.offsets)
        h = word_hashes(lower_ascii(t.data), start, end)
        count = np.bincount(row, minlength=len(t)) if len(t) else np.zeros(0, np.int64)
        n = len(h)
        first = np.flatnonzero(row[:n - width + 1] == row[width - 1:]) if n >= width else np.zeros(0, np.int64)
        grams = np.full(len(first), width, np.uint64)
        for k in range(width):
            grams = combine(grams, h[first + k])
        rows = row[first]
        # fewer words than a shingle: the whole sequence, tagged by its length
        begin = np.cumsum(count) - count
        short = np.flatnonzero((count > 0) & (count < width))
        if len(short):
            extra = count[short].astype(np.uint64)
            for k in range(width - 1):
                on = count[short] > k
                extra[on] = combine(extra[on], h[begin[short[on]] + k])
            grams, rows = np.concatenate([grams, extra]), np.concatenate([rows, short])
        o = np.lexsort((grams, rows))
        grams, rows = grams[o], rows[o]
        new = np.ones(len(o), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
        self.grams, self.rows = grams[new], rows[new]
        self.size = np.bincount(self.rows, minlength=len(t)) if len(t) else np.zeros(0, np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.size))).astype(np.int64)


def _chunk_counts(sets: _Sets, valid: np.ndarray, buckets: int):
    ok = valid[sets.rows]
    bucket, place, inverse = ch.distinct_places(sets.grams[ok], buckets)
    return bucket, place, inverse, np.bincount(inverse, minlength=len(place)) if len(place) else inverse


def _ask_frequencies(width: int, buckets: int):
    """Payload: places, then (position, count) of places held more than once."""
    def ask(key, table):
        t = Texts(table)
        bucket, place, _, count = _chunk_counts(_Sets(t, width), t.valid, buckets)
        parts = []
        for b, i, j in ch.by_bucket(bucket):
            many = np.flatnonzero(count[i:j] > 1).astype(np.uint32)
            parts.append((b, np.uint32(j - i).tobytes() + place[i:j].tobytes() + many.tobytes()
                          + np.minimum(count[i:j][many], 0xFFFFFFFF).astype(np.uint32).tobytes()))
        return ch.ask_table(key[0].as_py(), parts)
    return ask


def _answer_frequencies(table):
    """Sum the counts; answer 16 bits per asked place (65,535: or more)."""
    asks = sorted(zip(table.column("chunk").to_pylist(), ch.payloads(table)))
    head = np.int32(table.column("bucket")[0].as_py()).tobytes()
    places, counts = [], []
    for _, p in asks:
        n = int(np.frombuffer(p, np.uint32, 1)[0])
        rest = np.frombuffer(p, np.uint32, offset=4)
        c = np.ones(n, np.int64)
        many = (len(rest) - n) // 2
        c[rest[n:n + many]] = rest[n + many:]
        places.append(rest[:n])
        counts.append(c)
    uniq, inverse = np.unique(np.concatenate(places), return_inverse=True)
    total = np.minimum(np.bincount(inverse, np.concatenate(counts)), 65_535).astype(np.uint16)[inverse]
    cut = np.cumsum([0] + [len(p) for p in places])
    return ch.answer_table(FREQUENCY, [(c, head + total[cut[k]:cut[k + 1]].tobytes())
                                       for k, (c, _) in enumerate(asks)])


def _prefix_sets(width: int, percent: int, buckets: int):
    def run(key, docs, answers):
        t = Texts(docs)
        sets = _Sets(t, width)
        bucket, _, inverse, _ = _chunk_counts(sets, t.valid, buckets)
        got = {}
        for p in ch.payloads(answers):
            got[int(np.frombuffer(p, np.int32, 1)[0])] = np.frombuffer(p, np.uint16, offset=4)
        known = [got[b] for b, _, _ in ch.by_bucket(bucket)]
        freq = np.ones(len(sets.grams), np.int64)
        if known:
            freq[t.valid[sets.rows]] = np.concatenate(known)[inverse]
        n = sets.size
        need = -(-percent * n // 100)                     # least overlap with any partner
        prefix = np.where(n > 0, n - need + 1, 0)
        alone = np.bincount(sets.rows, weights=freq == 1, minlength=len(t)).astype(np.int64) if len(t) else n
        cand = (alone < prefix) & t.valid
        zero = np.zeros(len(t), np.uint64)
        key1, key2 = zero.copy(), zero.copy()
        filled = np.flatnonzero(n > 0)
        if len(filled):
            key1[filled] = np.add.reduceat(mix(sets.grams), sets.at[filled])
            key2[filled] = np.add.reduceat(mix(sets.grams ^ _U(0xA5A5A5A5A5A5A5A5)), sets.at[filled])
        grams, places, elements = [None] * len(t), [None] * len(t), [None] * len(t)
        for i in np.flatnonzero(cand).tolist():
            lo, hi = sets.at[i], sets.at[i + 1]
            g, f = sets.grams[lo:hi], freq[lo:hi]
            more = np.flatnonzero(f > 1)                  # hash order already
            take = more[np.argsort(f[more], kind="stable")][:prefix[i] - alone[i]]
            grams[i] = g[take].astype(np.int64)
            places[i] = (alone[i] + np.arange(len(take))).astype(np.int32)
            elements[i] = g[more].tobytes()
        return pa.table({
            "doc_id": pa.array(t.ids, pa.int64(), mask=~t.valid), "n": pa.array(n, pa.int64()),
            "key1": pa.array(key1.astype(np.int64)), "key2": pa.array(key2.astype(np.int64)),
            "candidate": pa.array(cand), "grams": pa.array(grams, pa.list_(pa.int64())),
            "places": pa.array(places, pa.list_(pa.int32())),
            "elements": pa.array(elements, pa.binary())})
    return run


def _linked(a: bytes, b: bytes, na: int, nb: int, percent: int, ranges: int = 16) -> bool:
    """Verify one pair. Elements of frequency one are in neither array."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    least = -(-percent * (na + nb) // (100 + percent))    # overlap a link needs
    if min(len(x), len(y)) < least:
        return False
    # suffix filter: no hash range holds more common elements than its smaller side
    cuts = (np.arange(1, ranges, dtype=np.uint64) << _U(60))
    cx = np.diff(np.concatenate(([0], np.searchsorted(x, cuts), [len(x)])))
    cy = np.diff(np.concatenate(([0], np.searchsorted(y, cuts), [len(y)])))
    if int(np.minimum(cx, cy).sum()) < least:
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum()) if len(y) else 0
    return 100 * both >= percent * (na + nb - both)


def _verify(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b, la, lb, linked) of candidate pairs of representatives and their
    classes; ``reps``: (rep, n, elements)."""
    full = (pairs.join(reps.toDF("b", "nb", "eb"), "b").join(reps.toDF("a", "na", "ea"), "a")
            .select("a", "b", "na", "nb", "ea", "eb", "la", "lb"))

    def run(batches):
        for batch in batches:
            a, b, na, nb, ea, eb, la, lb = batch.columns
            ok = [_linked(ea[i].as_py(), eb[i].as_py(), na[i].as_py(), nb[i].as_py(), percent)
                  for i in range(batch.num_rows)]
            yield pa.record_batch({"a": a, "b": b, "la": la, "lb": lb, "linked": pa.array(ok, pa.bool_())})
    return full.mapInArrow(run, "a long, b long, la long, lb long, linked boolean")


def _length_ok(na, nb, percent: int):
    """Length filter: the smaller set is at least t of the larger."""
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def shingle_sets(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, plan: ch.Plan | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Steps 1 and 2: ``SETS``, one row per input row; prefix elements of
    frequency two or more and their places for candidates."""
    plan = plan or ch.Plan(ch.text_bytes(docs, text_col))
    rows = ch.chunked(docs, plan, id_col, text_col)
    asks = rows.groupBy("chunk").applyInArrow(_ask_frequencies(width, plan.buckets), ch.ASK)
    freq = asks.groupBy("bucket").applyInArrow(_answer_frequencies, ch.ANSWER)
    return rows.groupBy("chunk").cogroup(freq.groupBy("chunk")).applyInArrow(
        _prefix_sets(width, percent, plan.buckets), SETS)


def near_duplicate_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT,
                           plan: ch.Plan | None = None, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row."""
    sets = written(shingle_sets(docs, width, percent, plan, id_col, text_col), "shingle-sets")
    keys = ["n", "key1", "key2"]
    cand = sets.filter("candidate")
    rep_of = materialize(cand.groupBy(*keys).agg(F.min("doc_id").alias("rep")), "set-classes")
    # One row per distinct set, named by its smallest document. Sets of one
    # doc_id share the name: they are one node.
    reps = (cand.join(rep_of, keys).filter(F.col("doc_id") == F.col("rep"))
            .dropDuplicates(["rep", *keys]))
    reps = materialize(reps.select("rep", "n", F.col("key1").alias("set_id"), "grams", "places", "elements"),
                       "representatives")
    # alone: elements no other document has; the places of a prefix start there
    postings = (reps.select("rep", "n", "set_id", F.element_at("places", 1).alias("alone"),
                            F.explode(F.arrays_zip("grams", "places")).alias("p"))
                .select(F.col("p.grams").alias("g"), "rep", "n", "set_id", "alone",
                        F.col("p.places").alias("place")))
    shared = postings.groupBy("g").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("g")
    postings = materialize(postings.join(shared, "g"), "postings")
    total = postings.count()

    sides = reps.select("rep", "n", "elements")
    labels = None                                         # (node, component) of linked representatives
    rows = postings.withColumn("label", F.col("rep"))

    def verified(pairs: DataFrame) -> DataFrame:
        """Verify, merge the classes of new links; (class, its new class)."""
        nonlocal labels
        done = materialize(_verify(materialize(pairs, "pairs"), sides, percent), "verified")
        merged = connected_components(done.filter("linked").select("la", "lb"), "la", "lb")
        if labels is None:
            labels = merged
        else:
            old = labels.join(merged.toDF("component", "to"), "component", "left") \
                .select("node", F.coalesce("to", "component").alias("component"))
            fresh = merged.join(labels.select("node"), "node", "left_anti")
            labels = materialize(old.unionByName(fresh), "labels")
        return merged

    def still_open(rows: DataFrame, merged: DataFrame | None) -> DataFrame:
        """Postings, newly labelled, of elements that touch several classes.
        Classes only grow, so an element once closed stays closed."""
        if merged is not None:
            rows = rows.join(merged.toDF("label", "to"), "label", "left") \
                .select("g", "rep", "n", "set_id", "alone", "place", F.coalesce("to", "label").alias("label"))
        span = rows.groupBy("g").agg(F.min("label").alias("l0"), F.max("label").alias("l1")) \
            .filter("l0 <> l1").select("g")
        return materialize(rows.join(span, "g").select(
            "g", "rep", "n", "set_id", "alone", "place", "label"), "open")

    def may_link(na, pa, ua, nb, pb, ub):
        """Length and positional filters of a pair sharing the elements at
        places pa and pb; ua and ub elements are its sides' own. No more
        elements can be common than lie before, at and after them."""
        need = F.ceil((na + nb) * percent / (100 + percent) - 1e-9)
        return (_length_ok(na, nb, percent)
                & (F.least(pa - ua, pb - ub) + F.least(na - pa, nb - pb) >= need))

    for turn in range(STAR_ROUNDS):
        if turn:
            per = rows.groupBy("g", "label").agg(F.count(F.lit(1)).cast("double").alias("c")) \
                .groupBy("g").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
            left = per.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()[0] or 0
            if left <= 4 * total:
                break
        # the text the others were copied from has the fewest elements of its own
        order = F.struct(F.col("alone") if turn == 0 else F.xxhash64("rep", F.lit(turn)).alias("h"),
                         "rep", "n", "label", "place", F.col("alone").alias("own"))
        hub = rows.groupBy("g").agg(F.min(order).alias("hub"))
        mine, other = F.col("rep") < F.col("hub.rep"), F.col("hub.label")
        pairs = (rows.join(hub, "g").filter(F.col("label") != other)
                 .filter(may_link(F.col("n"), F.col("place"), F.col("alone"),
                                  F.col("hub.n"), F.col("hub.place"), F.col("hub.own")))
                 .select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b"),
                         F.when(mine, F.col("label")).otherwise(other).alias("la"),
                         F.when(mine, other).otherwise(F.col("label")).alias("lb")).distinct())
        rows = still_open(rows, verified(pairs))
    # Every remaining pair comes out once, at its first common prefix element:
    # each posting carries the prefix elements before its own.
    before = F.slice("grams", F.lit(1), F.col("place") - F.col("alone"))
    last = (rows.join(reps.select("rep", "set_id", "grams"), ["rep", "set_id"])
            .select("g", "rep", "n", "alone", "place", "label", before.alias("before")))
    last = materialize(last, "last-postings")
    x = last.toDF("g", "a", "na", "ua", "pa", "la", "ba")
    y = last.toDF("g", "b", "nb", "ub", "pb", "lb", "bb")
    pairs = (x.join(y, (x["g"] == y["g"]) & (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb"))
                    & may_link(*(F.col(c) for c in ("na", "pa", "ua", "nb", "pb", "ub")))
                    & ~F.arrays_overlap("ba", "bb"))
             .select("a", "b", "la", "lb").distinct())
    verified(pairs)

    # rows sharing a doc_id are one node
    row_rep = cand.select("doc_id", *keys).join(rep_of.select("rep", *keys), keys)
    same = row_rep.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    joined = row_rep.select("doc_id", "rep").join(same.filter("a <> b").select("doc_id", "a"), "doc_id") \
        .filter("rep <> a").select("a", F.col("rep").alias("b"))
    if joined.limit(1).count():
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = connected_components(known.union(joined))
    classes = rep_of.join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
        .select(*keys, F.coalesce("component", "rep").alias("component"))
    out = sets.select("doc_id", *keys, "candidate") \
        .join(classes.withColumn("candidate", F.lit(True)), [*keys, "candidate"], "left")
    by_doc = out.groupBy("doc_id").agg(F.min("component").alias("component"), F.count(F.lit(1)).alias("rows"))
    repeated = by_doc.filter("rows > 1 AND doc_id IS NOT NULL").select("doc_id", F.col("component").alias("least"))
    return (out.join(repeated, "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(),
                           F.coalesce("least", "component", "doc_id")).alias("component_id")))
