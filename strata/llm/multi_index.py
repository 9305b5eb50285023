"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to unit length and cut in two halves. Each half has its own
codebook of K centroids (k-means on a bounded sample); the K x K pairs of
centroids are the cells, and a vector is stored in the cell of its nearest
pair. From a vector, the multi-sequence traversal visits cells in the order of
their distance (the sum of two sorted lists, by a heap) until the distance
passes that of its own cell by ``margin``; it is compared with every vector
stored there. A pair counts when either vector reaches the other's cell.

``margin`` is set by the target recall: bounded sample queries are compared
with all vectors, and the margin is the least one at which the target share of
their links (over all links, and averaged over queries) is reached, and
``LEAST_MARGIN`` for links that the sample does not hold. Where the
sample has fewer than ``LEAST_LINKS`` links, the links of random neighbours at
exactly the least cosine are taken, which are the hardest to reach. A margin
of ``|u - v|`` at the least cosine finds every link: if v is no further from
its centroids than u is from its own, ``|u - c(v)| <= |u - v| + |u - c(u)|``.

Every vector is indexed; the codebooks, the sample queries and the margin are
the only things fitted, on at most ``SAMPLE_ROWS`` and ``SAMPLE_QUERIES``
rows. Equal vectors are one class with a count and are compared once. Vectors
of a cell are cut into blocks by a hash, queries too; a task compares a block
with a block, so a cell of any size is many tasks. Only links and a spanning
forest leave a task, no list of pairs. Cells that many near copies share
take work in proportion to the square of their distinct vectors.

Defined cases: rows without an id take no part; vectors that are null, empty,
zero or hold null or non-finite components link with nothing; vectors of
different length do not link; of rows that share an id, the one whose vector
has the smallest digest counts, usable ones first; other columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.llm.stages import written
from strata.llm.vptree import unit_rows

LEAST_COSINE = 0.95
TARGET_RECALL = 0.995
CELL_ROWS = 32
MOST_CENTROIDS = 1024
SAMPLE_ROWS = 16_384
SAMPLE_QUERIES = 512
LEAST_LINKS = 100
BLOCK = 4096
BINS = 1000
LEAST_MARGIN = 0.012
PACKED = "vec_id long, dim int, vec binary, digest binary"


def packed(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, dim, vector as bytes of doubles, digest); nulls where unusable."""
    def task(batches):
        for batch in batches:
            ids, dims, vecs, digests = [], [], [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("vector")):
                flat = v.values
                x = None if flat is None or flat.null_count else np.asarray(flat, np.float64)
                if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                    ids, dims, vecs, digests = ids + [i], dims + [None], vecs + [None], digests + [None]
                    continue
                raw = x.tobytes()
                ids.append(i)
                dims.append(len(x))
                vecs.append(raw)
                digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(vecs, pa.binary()), pa.array(digests, pa.binary())],
                                             ["vec_id", "dim", "vec", "digest"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vector"))
    return rows.filter("vec_id IS NOT NULL").mapInArrow(task, PACKED)


def unpack(column, dim: int) -> np.ndarray:
    """Unit vectors of a column of packed vectors."""
    raw = b"".join(column.to_pylist())
    x = np.frombuffer(raw, np.float64).reshape(-1, dim)
    return unit_rows(x) if len(x) else x


def centroids(x: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """k-means by Lloyd's rounds; empty clusters keep their centroid."""
    kinds = np.unique(x, axis=0)
    c = kinds[np.random.default_rng(seed).permutation(len(kinds))[:k]].copy()
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        size = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


class Grid:
    """Two codebooks; cell (i, j) has the number i * len(second) + j."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.half = first.shape[1]

    def distances(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves to all centroids."""
        out = []
        for part, c in ((u[:, :self.half], self.first), (u[:, self.half:], self.second)):
            out.append(np.maximum((part * part).sum(1)[:, None] - 2 * part @ c.T + (c * c).sum(1), 0))
        return out[0], out[1]

    def home(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of every vector and its distance from it."""
        a, b = self.distances(u)
        return a.argmin(1) * len(self.second) + b.argmin(1), np.sqrt(a.min(1) + b.min(1))

    def to_cells(self, u: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Distance of every vector from one cell each."""
        a, b = self.distances(u)
        at = np.arange(len(u))
        return np.sqrt(a[at, cells // len(self.second)] + b[at, cells % len(self.second)])

    def traverse(self, u: np.ndarray, margin: float) -> list[list[int]]:
        """Cells of every vector in the order of distance, its own first, up
        to the margin: the multi-sequence algorithm over two sorted lists."""
        a, b = self.distances(u)
        by_a, by_b = np.argsort(a, 1, kind="stable"), np.argsort(b, 1, kind="stable")
        a, b = np.take_along_axis(a, by_a, 1), np.take_along_axis(b, by_b, 1)
        limit = (np.sqrt(a[:, 0] + b[:, 0]) + margin) ** 2 + 1e-12
        width = len(self.second)
        out = []
        for r in range(len(u)):
            da, db, far = a[r], b[r], limit[r]
            heap, cells = [(da[0] + db[0], 0, 0)], []
            while heap:
                d, i, j = heapq.heappop(heap)
                if d > far:
                    break
                cells.append(int(by_a[r, i]) * width + int(by_b[r, j]))
                if j + 1 < len(db):                  # each (i, j) is pushed once: along j, and along i at j = 0
                    heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
                if j == 0 and i + 1 < len(da):
                    heapq.heappush(heap, (da[i + 1] + db[0], i + 1, 0))
            out.append(cells)
        return out


def fit_grid(reps: DataFrame, dim: int, n: int, cell_rows: int) -> tuple[Grid, np.ndarray]:
    """Codebooks from a bounded sample, and the sample queries."""
    k = min(MOST_CENTROIDS, max(1, math.ceil(math.sqrt(n / cell_rows))))
    by = F.xxhash64("rep", F.lit(11))
    sample = reps.select("rep", "vec").orderBy(by, "rep").limit(SAMPLE_ROWS).toArrow()
    u = unpack(sample.column("vec"), dim)
    half = dim // 2
    return Grid(centroids(u[:, :half], k, 1), centroids(u[:, half:], k, 2)), u[:SAMPLE_QUERIES]


def needed_margin(grid: Grid, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Least margins at which the pairs of rows of u and v are compared."""
    cu, du = grid.home(u)
    cv, dv = grid.home(v)
    return np.maximum(np.minimum(grid.to_cells(u, cv) - du, grid.to_cells(v, cu) - dv), 0)


def margin_for(reps: DataFrame, grid: Grid, queries: np.ndarray, least: float, target: float) -> float:
    """The least margin that reaches the target recall on the sample queries
    (see the module's text); counted in ``BINS`` steps of the margin that finds all."""
    dim, most = queries.shape[1], math.sqrt(max(2 - 2 * least, 0.0))

    def task(batches):
        for batch in batches:
            u = unpack(batch.column("vec"), dim)
            cosine = u @ queries.T
            at, q = np.nonzero((cosine >= least) & (cosine < 1 - 1e-12))
            step = np.zeros(0, np.int64)
            if len(at):
                step = np.ceil(needed_margin(grid, u[at], queries[q]) / most * BINS).astype(np.int64)
            pair, n = np.unique(np.stack([q, step]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0], pa.int64()), pa.array(pair[1], pa.int64()),
                                              pa.array(n, pa.int64())], ["q", "step", "n"])

    rows = (reps.select("vec").mapInArrow(task, "q long, step long, n long")
            .groupBy("q", "step").agg(F.sum("n").alias("n")).collect())       # at most queries x steps
    if sum(r["n"] for r in rows) >= LEAST_LINKS:
        links = np.zeros((len(queries), BINS + 2), np.int64)
        for r in rows:
            links[r["q"], min(r["step"], BINS + 1)] += r["n"]
        links = links[links.sum(1) > 0]
        reached = np.minimum(links.sum(0).cumsum() / links.sum(),
                             (links.cumsum(1) / links.sum(1)[:, None]).mean(0))
        return min(int(np.argmax(reached >= target)), BINS) / BINS * most
    noise = np.random.default_rng(3).normal(size=queries.shape)
    noise -= (noise * queries).sum(1)[:, None] * queries
    size = np.sqrt((noise * noise).sum(1))
    if not (size > 1e-9).all():                       # one dimension: neighbours are copies
        return most
    near = least * queries + math.sqrt(max(1 - least * least, 0.0)) * noise / size[:, None]
    return float(np.quantile(needed_margin(grid, queries, near), target, method="higher"))


def _placed(reps: DataFrame, grid: Grid, margin: float, dim: int) -> DataFrame:
    """Representatives with their cell and the other cells they visit."""
    def task(batches):
        for batch in batches:
            cells = grid.traverse(unpack(batch.column("vec"), dim), margin)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), batch.column("vec"),
                 pa.array([c[0] for c in cells], pa.int64()), pa.array([c[1:] for c in cells], pa.list_(pa.int64()))],
                ["rep", "copies", "vec", "home", "others"])
    return reps.select("rep", "copies", "vec").mapInArrow(
        task, "rep long, copies long, vec binary, home long, others array<long>")


def _compare(least: float, dim: int):
    """Links between a block of stored vectors and a block of queries: (rep,
    weight of its links, a linked rep or null). A pair that is met from both
    sides counts on the side of the smaller cell; a pair of one cell once."""
    def compare(key, left, right):
        node, weight, other = [], [], []
        if left.num_rows and right.num_rows:
            ids, q_ids = np.asarray(left.column("rep")), np.asarray(right.column("rep"))
            w, q_w = np.asarray(left.column("copies")), np.asarray(right.column("copies"))
            q_home = np.asarray(right.column("home"))
            others = [set(o) for o in left.column("others").to_pylist()]
            cell = key[0].as_py()
            u, q = unpack(left.column("vec"), dim), unpack(right.column("vec"), dim)
            found, q_found = np.zeros(len(ids), np.int64), np.zeros(len(q_ids), np.int64)
            root = np.arange(len(ids) + len(q_ids))
            step = max(1, 2_000_000 // max(len(ids), 1))
            edges = []
            for lo in range(0, len(q_ids), step):
                at, row = np.nonzero(q[lo:lo + step] @ u.T >= least)
                at += lo
                foreign = q_home[at] != cell
                good = foreign | (q_ids[at] > ids[row])
                twice = np.fromiter((h in others[r] for h, r in zip(q_home[at[foreign]].tolist(), row[foreign].tolist())),
                                    bool, int(foreign.sum()))
                good[foreign] &= ~(twice & (q_home[at[foreign]] < cell))
                at, row = at[good], row[good]
                np.add.at(found, row, q_w[at])
                np.add.at(q_found, at, w[row])
                edges.append(_forest(root, row, len(ids) + at))
            names, total = np.concatenate([ids, q_ids]), np.concatenate([found, q_found])
            x, y = (np.concatenate(e) for e in zip(*edges)) if edges else (np.zeros(0, int),) * 2
            some = np.flatnonzero(total)
            node = np.concatenate([names[some], names[x]])
            weight = np.concatenate([total[some], np.zeros(len(x), np.int64)])
            other = np.ma.concatenate([np.ma.masked_all(len(some), np.int64), np.ma.array(names[y])])
            other = pa.array(other.filled(0), pa.int64(), mask=np.ma.getmaskarray(other))
        return pa.table({"rep": pa.array(node, pa.int64()), "links": pa.array(weight, pa.int64()),
                         "other": other if isinstance(other, pa.Array) else pa.array(other, pa.int64())})
    return compare


def _forest(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span what a-b links join beyond ``root``; ``root`` follows."""
    x, y = [], []
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, high, low = a[apart], b[apart], np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart]
        # every root hooks to its smallest neighbour
        by = np.lexsort((low, high))
        first = np.ones(len(by), bool)
        first[1:] = high[by][1:] != high[by][:-1]
        pick = by[first]
        x.append(a[pick])
        y.append(b[pick])
        root_of = np.arange(len(root))
        root_of[high[pick]] = low[pick]
        while True:
            nxt = root_of[root_of]
            if np.array_equal(nxt, root_of):
                break
            root_of = nxt
        root[:] = root_of[root]
    none = np.zeros(0, np.int64)
    return (np.concatenate(x), np.concatenate(y)) if x else (none, none)


def _links(reps: DataFrame, dim: int, least: float, target: float, cell_rows: int, block: int) -> DataFrame:
    """(rep, links, other) of the representatives of one length."""
    n = reps.count()
    grid, queries = fit_grid(reps, dim, n, cell_rows)
    margin = max(LEAST_MARGIN, margin_for(reps, grid, queries, least, target))
    placed = written(_placed(reps, grid, margin, dim), "placed")
    # at most MOST_CENTROIDS squared rows: the cells
    stored = placed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    asked = (placed.select(F.explode(F.concat(F.array("home"), "others")).alias("cell")).groupBy("cell")
             .agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts")))
    cells = F.broadcast(written(stored.join(asked, "cell"), "cells"))
    deal = F.xxhash64("rep", F.lit(5))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    homes = (placed.withColumn("cell", F.col("home")).join(cells, "cell")
             .withColumn("block", F.pmod(deal, F.col("blocks")).cast("int")).withColumn("part", spread("parts"))
             .select("cell", "block", "part", "rep", "copies", "vec", "others"))
    asks = (placed.withColumn("cell", F.explode(F.concat(F.array("home"), "others"))).join(cells, "cell")
            .withColumn("part", F.pmod(deal, F.col("parts")).cast("int")).withColumn("block", spread("blocks"))
            .select("cell", "block", "part", "rep", "copies", "vec", "home")
            .toDF("cell", "block", "part", "rep", "copies", "vec", "home"))          # names of its own
    keys = ["cell", "block", "part"]
    return homes.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(
        _compare(least, dim), "rep long, links long, other long")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                           least: float = LEAST_COSINE, target: float = TARGET_RECALL,
                           cell_rows: int = CELL_ROWS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every id."""
    rows = written(packed(vectors, id_col, vec_col), "packed")
    ids = rows.groupBy("vec_id").agg(F.min("digest").alias("digest"))
    kinds = written(ids.filter("digest IS NOT NULL").groupBy("digest")
                    .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "kinds")
    reps = written(rows.join(kinds.withColumnRenamed("digest", "d"),
                             (F.col("vec_id") == F.col("rep")) & (F.col("digest") == F.col("d")))
                   .dropDuplicates(["rep"]).select("rep", "copies", "dim", "vec"), "reps")
    links = None
    for row in reps.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("dim").collect():
        part = written(_links(reps.filter(F.col("dim") == row["dim"]), row["dim"], least, target, cell_rows, block), "links")
        links = part if links is None else links.union(part)
    salts = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt")
    if links is None:
        classes = kinds.select("digest", (F.col("copies") - 1).alias("n_links"), F.col("rep").alias("component_id"))
    else:
        counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
        joined = connected_components(links.filter("other IS NOT NULL").select("rep", "other"), "rep", "other")
        classes = (kinds.join(counted, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                           F.coalesce("component", "rep").alias("component_id")))
    salted = ids.withColumn("salt", F.pmod("vec_id", F.lit(16)).cast("int"))
    out = salted.join(classes.select("*", salts), ["digest", "salt"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
