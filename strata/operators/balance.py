"""Class balance: balanced class weights (B2) and SMOTE."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

LABEL = "label"


def class_weight_table(df: DataFrame, label: str = LABEL, group_cols=()) -> DataFrame:
    """weight_c = n / (n_classes * n_c) -- with two classes n / (2 n_c)."""
    g = list(group_cols)
    counts = df.groupBy(*g, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*g) if g else Window.partitionBy()
    return counts.withColumn("weight", F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n")))


def with_class_weights(df: DataFrame, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's class (small table join)."""
    wt = class_weight_table(df, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(wt), label, "left")


# ----------------------------------------------------------------- SMOTE

PIVOT_SAMPLE = 20_000
MOST_PIVOTS = 2048
KNN = "id long, nbr_id long, dist double"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-by-row distances by differences, not norms: equal rows give zero."""
    out = np.empty((len(a), len(b)))
    for i, row in enumerate(a):
        out[i] = np.sqrt(((b - row) ** 2).sum(1))
    return out


def _k_nearest(ids: np.ndarray, d: np.ndarray, me: int, k: int) -> np.ndarray:
    """Places of the k smallest distances, own id left out, ties by id."""
    if len(d) > k + 1:
        worst = np.partition(d, k)[k]
        near = np.flatnonzero(d <= worst)
    else:
        near = np.arange(len(d))
    near = near[ids[near] != me]
    return near[np.lexsort((ids[near], d[near]))[:k]]


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    flat = np.concatenate([np.asarray(c.flatten(), np.float64) for c in table.column("vec").chunks] or [np.zeros(0)])
    return np.asarray(table.column("id")), flat.reshape(table.num_rows, -1)


def _found(ids: np.ndarray, x: np.ndarray, others: np.ndarray, y: np.ndarray, k: int) -> pa.Table:
    who, nbr, dist = [], [], []
    for lo in range(0, len(ids), 256):
        for me, d in zip(ids[lo:lo + 256].tolist(), _distances(x[lo:lo + 256], y)):
            keep = _k_nearest(others, d, me, k)
            who += [me] * len(keep)
            nbr += others[keep].tolist()
            dist += d[keep].tolist()
    return pa.table({"id": pa.array(who, pa.int64()), "nbr_id": pa.array(nbr, pa.int64()),
                     "dist": pa.array(dist, pa.float64())})


def _pivots(pts: DataFrame, n: int, block_rows: int) -> np.ndarray:
    """Pivots of the cells: about one per half block, far apart, chosen from a
    bounded sample (each next one is the sample row furthest from the others)."""
    sample = pts.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("id", "vec").toArrow()
    _, x = _rows(sample)
    want = min(MOST_PIVOTS, max(1, -(-2 * n // block_rows)), len(x))
    chosen = [0]
    far = np.sqrt(((x - x[0]) ** 2).sum(1))
    while len(chosen) < want and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.sqrt(((x - x[chosen[-1]]) ** 2).sum(1)))
    return x[chosen]


def knn_within(points: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "vec",
               block_rows: int = 2048) -> DataFrame:
    """Exact k nearest neighbours of every point among the same points.

    Points lie in the cell of their nearest pivot; a cell has the radius of its
    furthest point, and is cut by a hash into blocks of about ``block_rows``.
    First every block finds its points' k nearest in itself: the k-th distance
    bounds the true one. Then a point goes to another cell's blocks only if the
    cell can hold a nearer point: ``d(point, pivot) - radius``, and half the
    excess over its own pivot's distance measured between the pivots, are both
    within the bound. A ranked window merges the results (ties by id).

    A point is copied once for each block that it has to visit, a stored point
    once for about ``block_rows`` visits: on clustered points that is a small
    share of all pairs of blocks (``knn_visits``), on points without structure
    in many dimensions no bound prunes and it is all of them. Pivots and cell
    sizes (``MOST_PIVOTS`` rows at most) are sent to all tasks.
    Returns (id, nbr_id, rank, dist).
    """
    visits, near = _knn_phases(points, k, id_col, vec_col, block_rows)
    found = near if visits is None else near.unionByName(_visited(visits[0], visits[1], k, block_rows))
    wn = Window.partitionBy("id").orderBy("dist", "nbr_id")
    return (found.withColumn("rank", F.row_number().over(wn)).filter(F.col("rank") <= k)
                 .select("id", "nbr_id", F.col("rank").cast("int"), "dist"))


def knn_visits(points: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "vec",
               block_rows: int = 2048) -> tuple[int, int]:
    """(visits of points to blocks other than their own, visits if nothing were
    pruned): the work that the bounds leave."""
    visits, _ = _knn_phases(points, k, id_col, vec_col, block_rows)
    if visits is None:
        return 0, 0
    blocks = visits[1].select("cell", "block").distinct().count()
    return visits[0].count(), visits[1].count() * (blocks - 1)


def _knn_phases(points: DataFrame, k: int, id_col: str, vec_col: str, block_rows: int):
    """((visits, stored points) or None if there is one block, first results)."""
    pts = materialize(points.select(F.col(id_col).cast("long").alias("id"), F.transform(
        F.col(vec_col), lambda x: x.cast("double")).alias("vec")), "knn-points")
    n = pts.count()
    if n <= block_rows:
        def alone(table: pa.Table) -> pa.Table:
            ids, x = _rows(table)
            return _found(ids, x, ids, x, k)
        return None, pts.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(alone, KNN)
    pivots = _pivots(pts, n, block_rows)

    def place(batches):
        for batch in batches:
            ids, x = _rows(pa.table(batch))
            d = _distances(x, pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vec"), pa.array(d.argmin(1), pa.int32()),
                 pa.array(d.min(1) if len(ids) else [], pa.float64())], ["id", "vec", "cell", "away"])

    placed = materialize(pts.mapInArrow(place, "id long, vec array<double>, cell int, away double"), "knn-cells")
    # one row per pivot
    cells = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    stats = {r["cell"]: (r["radius"], r["blocks"]) for r in cells.collect()}
    radius = np.array([stats.get(c, (-np.inf, 0))[0] for c in range(len(pivots))])
    blocks = np.array([stats.get(c, (0, 0))[1] for c in range(len(pivots))])
    count = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1)
    stored = placed.withColumn("block", F.pmod(F.xxhash64("id"), count).cast("int"))

    def own(key, table):
        ids, x = _rows(table)
        got = _found(ids, x, ids, x, k)
        bound = np.full(len(ids), np.inf)
        order = np.argsort(ids, kind="stable")
        who, dist = np.asarray(got["id"]), np.asarray(got["dist"])
        names, size = np.unique(who, return_counts=True)
        worst = np.zeros(len(names))
        np.maximum.at(worst, np.searchsorted(names, who), dist)
        at = order[np.searchsorted(ids[order], names)]
        bound[at] = np.where(size >= k, worst, np.inf)
        bounds = pa.table({"id": pa.array(ids, pa.int64()), "nbr_id": pa.nulls(len(ids), pa.int64()),
                           "dist": pa.array(bound, pa.float64())})
        return pa.concat_tables([got, bounds])

    first = materialize(stored.groupBy("cell", "block").applyInArrow(own, KNN), "knn-own")
    bounds = first.filter("nbr_id IS NULL").select("id", F.col("dist").alias("bound"))
    between = _distances(pivots, pivots)

    def travel(batches):
        for batch in batches:
            ids, x = _rows(pa.table(batch))
            home, mine = np.asarray(batch.column("cell")), np.asarray(batch.column("block"))
            bound, d = np.asarray(batch.column("bound")), _distances(x, pivots)
            slack = 1e-9 * (1 + d)                                         # rounding must not skip a tie
            reach = d - radius - slack <= bound[:, None]
            own_d = d[np.arange(len(ids)), home][:, None] if len(ids) else d
            apart = between[home]
            half = np.divide(d * d - own_d * own_d, 2 * apart, out=np.zeros_like(d), where=apart > 0)
            reach &= half - slack <= bound[:, None]
            row, cell = np.nonzero(reach & (blocks > 0))
            times = blocks[cell]
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            other = (cell != home[row]) | (block != mine[row])
            row, cell, block = row[other], cell[other], block[other]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row], pa.int64()), batch.column("vec").take(pa.array(row)), pa.array(cell, pa.int32()),
                 pa.array(block, pa.int32())], ["id", "vec", "cell", "block"])

    visits = (stored.join(bounds, "id").select("id", "vec", "cell", "block", "bound")
              .mapInArrow(travel, "id long, vec array<double>, cell int, block int"))
    return (visits, stored.select("id", "vec", "cell", "block")), first.filter("nbr_id IS NOT NULL")


def _visited(visits: DataFrame, stored: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Results of the visits; many visits to one block are cut into parts."""
    visits = materialize(visits, "knn-visits")
    parts = visits.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / (4 * block_rows)).cast("int").alias("parts"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    left = visits.join(parts, ["cell", "block"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    right = stored.join(parts, ["cell", "block"]).withColumn("part", every)
    cols = ["cell", "block", "part", "id", "vec"]

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "nbr_id": pa.array([], pa.int64()),
                             "dist": pa.array([], pa.float64())})
        return _found(*_rows(a), *_rows(b), k)

    keys = ["cell", "block", "part"]
    return (left.select(*cols).toDF(*cols).groupBy(*keys)
            .cogroup(right.select(*cols).toDF(*cols).groupBy(*keys)).applyInArrow(meet, KNN))


def smote(train: DataFrame, k: int = 5, seed: int = 42, id_col: str = "id", vec_col: str = "vec",
          label: str = LABEL, broadcast_bytes: int = 64_000_000, rows_per_partition: int = 1_000_000) -> DataFrame:
    """Oversample the minority class to the majority count.

    The deficit's sample ids s = 0 .. deficit-1 come from ``spark.range``
    spread over many partitions (never one task per minority row: a tiny
    minority facing a huge majority would make each row emit millions).
    Sample s belongs to minority row number (s mod m) + 1, so rows get the
    deficit evenly; it uses that row's neighbour ``hash(s) mod k_i`` and step
    u = hash-uniform in [0, 1): x_new = x + u (x_nn - x).
    Minority rows and their neighbour lists (k + 1 vectors a row) are joined by
    broadcast when they take at most ``broadcast_bytes``, counted from rows and
    vector length, otherwise by a shuffle join. Output: (id, vec, label, synthetic).
    """
    from strata.operators.ranking import exact_row_number

    spark = train.sparkSession
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    base = train.select(F.col(id_col).alias("id"),
                        F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("vec"),
                        F.col(label).alias(label))
    if len(counts) < 2:
        return base.withColumn("synthetic", F.lit(False))
    minority = min(counts, key=lambda c: (counts[c], c))
    majority = max(counts, key=lambda c: (counts[c], -c))
    m, deficit = counts[minority], counts[majority] - counts[minority]
    mino = base.filter(F.col(label) == minority)
    nn = knn_within(mino.select("id", "vec"), k)
    kk = nn.groupBy("id").agg(F.count(F.lit(1)).alias("k_i"))
    pos = exact_row_number(mino.select("id"), [F.col("id")], (), out="pos")
    rows = (pos.join(kk, "id", "inner").join(mino.select("id", F.col("vec").alias("x")), "id")
               .select("pos", "id", "k_i", "x"))
    nbrs = nn.join(mino.select(F.col("id").alias("nbr_id"), F.col("vec").alias("xn")), "nbr_id") \
             .select("id", "rank", "xn")
    width = mino.agg(F.max(F.size("vec"))).first()[0] or 0
    small = m * (k + 1) * (8 * width + 32) <= broadcast_bytes
    parts = max(1, min(deficit // rows_per_partition + 1, 100_000))
    samples = spark.range(0, deficit, 1, parts).select(
        F.col("id").alias("s"), (F.col("id") % F.lit(m) + 1).alias("pos"))
    j = samples.join(F.broadcast(rows) if small else rows, "pos")
    h = F.xxhash64(F.col("id"), F.col("s"), F.lit(seed))
    j = j.withColumn("rank", (F.pmod(h, F.col("k_i")) + 1).cast("int")).withColumn(
        "u", F.pmod(F.xxhash64(F.col("id"), F.col("s"), F.lit(seed), F.lit("u")), F.lit(1 << 30))
        / F.lit(float(1 << 30)))
    j = j.join(F.broadcast(nbrs) if small else nbrs, ["id", "rank"])
    syn = j.select((-(F.col("s") + 1)).alias("id"),
                   F.zip_with("x", "xn", lambda a, b: a + F.col("u") * (b - a)).alias("vec"),
                   F.lit(minority).cast(base.schema[label].dataType).alias(label),
                   F.lit(True).alias("synthetic"))
    return base.withColumn("synthetic", F.lit(False)).unionByName(syn)
