"""Approximate nearest neighbours by cosine with one vantage-point tree a shard.

Vectors are scaled to unit length; on the unit sphere the Euclidean distance
is a metric and falls as the cosine rises (d^2 = 2 - 2 cos). A node splits its
rows at the median distance to its vantage point and keeps the distance range
of either half. A search goes to the nearer half first and skips a half when
``factor`` times its least possible distance exceeds the k-th distance found:
factor 1 is the triangle inequality itself (exact search), larger factors skip
more and may miss neighbours.

Every row is indexed. ``recall`` measures found neighbours against brute
force; the default factor was measured on the embeddings tables (README).

Defined cases: see ``vectors``; zero vectors take no part; a query with fewer
candidates than k gets all of them; ties go to the smaller vec_id.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import vectors as vs

LEAF = 256
FACTOR = 1.2


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so
    very large and very small vectors neither overflow nor vanish."""
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


class Tree:
    """Nodes: (vantage, near, far, near_low, near_high, far_low, far_high);
    a leaf is the slice [near, far) of ``order`` with vantage -1."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        self.ids, self.x = ids, x
        self.unit = unit_rows(x)
        self.order = np.arange(len(ids))
        self.nodes: list[tuple] = []
        self.root = self._node(0, len(ids), leaf) if len(ids) else -1
        self.unit_in_order = self.unit[self.order]

    def __getstate__(self):
        small = self.x.astype(np.float32)
        x = small if np.array_equal(small, self.x) else self.x
        return self.ids, x, self.order, self.nodes, self.root

    def __setstate__(self, state):
        self.ids, x, self.order, self.nodes, self.root = state
        self.x = x.astype(np.float64)
        self.unit = unit_rows(self.x)
        self.unit_in_order = self.unit[self.order]

    def _node(self, lo: int, hi: int, leaf: int) -> int:
        rows = self.order[lo:hi]
        me = len(self.nodes)
        self.nodes.append(())
        if len(rows) > leaf:
            # a row far from the shard's first row sees the distances best
            v = int(rows[int(np.argmin(self.unit[rows] @ self.unit[rows[0]]))])
            d = np.sqrt(np.maximum(2 - 2 * (self.unit[rows] @ self.unit[v]), 0))
            by = np.argsort(d, kind="stable")
            self.order[lo:hi] = rows[by]
            d = d[by]
            mid = len(rows) // 2
            near = self._node(lo, lo + mid, leaf)
            far = self._node(lo + mid, hi, leaf)
            self.nodes[me] = (v, near, far, float(d[0]), float(d[mid - 1]), float(d[mid]), float(d[-1]))
        else:
            self.nodes[me] = (-1, lo, hi, 0.0, 0.0, 0.0, 0.0)
        return me

    def search(self, own: int, q: np.ndarray, k: int, factor: float) -> np.ndarray:
        """Rows of the k nearest found (by cosine), the row ``own`` left out."""
        if self.root < 0:
            return np.zeros(0, np.int64)
        unit = unit_rows(q[None, :])[0]
        vantages = {}
        found_rows = np.zeros(0, np.int64)
        found_cos = np.zeros(0)
        bound = np.inf
        stack = [(0.0, self.root)]
        while stack:
            least, n = stack.pop()
            if factor * least > bound + 1e-9:
                continue
            v, a, b, a_low, a_high, b_low, b_high = self.nodes[n]
            if v < 0:
                cos = self.unit_in_order[a:b] @ unit
                if bound < np.inf:
                    good = np.flatnonzero(2 - 2 * cos <= bound * bound + 1e-9)
                    if len(good) == 0:
                        continue
                    rows, cos = self.order[a:b][good], cos[good]
                else:
                    rows = self.order[a:b]
                other = self.ids[rows] != own
                rows = np.concatenate([found_rows, rows[other]])
                cos = np.concatenate([found_cos, cos[other]])
                keep = np.lexsort((self.ids[rows], -cos))[:k]
                found_rows, found_cos = rows[keep], cos[keep]
                if len(found_rows) == k:
                    bound = float(np.sqrt(max(2 - 2 * found_cos[-1], 0.0)))
                continue
            d = vantages.get(v)
            if d is None:
                d = vantages[v] = float(np.sqrt(max(2 - 2 * float(self.unit[v] @ unit), 0.0)))
            to_near = max(a_low - d, d - a_high, 0.0, least)
            to_far = max(b_low - d, d - b_high, 0.0, least)
            if to_near <= to_far:
                stack.append((to_far, b))
                stack.append((to_near, a))
            else:
                stack.append((to_near, a))
                stack.append((to_far, b))
        return found_rows


def nearest_by_cosine(vectors: DataFrame, is_query, k: int = 5, factor: float = FACTOR,
                      leaf: int = LEAF, id_col: str = "vec_id", vec_col: str = "embedding",
                      shard_rows: int = vs.SHARD_ROWS) -> DataFrame:
    """Each query's k nearest found over all other rows: (query_id, rank,
    vec_id, score); the score is the cosine of the original vectors."""
    nonzero = vectors.filter(F.exists(F.col(vec_col).cast("array<double>"), lambda x: x != 0))

    def build(ids, x):
        return pickle.dumps(Tree(ids, x, leaf), protocol=5)

    def find(image, q_ids, q):
        tree: Tree = pickle.loads(image)
        at, vec, score = [], [], []
        for j, (i, row) in enumerate(zip(q_ids.tolist(), q)):
            rows = tree.search(i, row, k, factor)
            at += [j] * len(rows)
            vec += tree.ids[rows].tolist()
            score += (tree.unit[rows] @ unit_rows(row[None, :])[0]).tolist()
        return at, vec, score

    return vs.search(nonzero, build, find, k, "double", is_query, id_col, vec_col, shard_rows)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact (query_id, vec_id) pairs that were found."""
    keys = ["query_id", "vec_id"]
    got = exact.select(*keys).join(found.select(*keys, F.lit(1).alias("hit")), keys, "left") \
        .agg(F.count("hit").alias("h"), F.count(F.lit(1)).alias("n")).first()
    return got["h"] / got["n"] if got["n"] else 1.0
