"""Exact top-k inner product with M-trees searched best first.

Components become floor(scale * x). Largest inner product is turned into
nearest neighbour under the Euclidean metric by one more coordinate: with M
the largest squared length of the shard, a vector v becomes
(v, sqrt(M - |v|^2)) and a query (q, 0), so
d(q, v)^2 = |q|^2 + M - 2 <q, v>.

Each shard holds one M-tree in pages. A page lists routing entries (object,
covering radius, distance to the parent object, child page) or, in a leaf,
objects with their distance to the parent. A search keeps pages in a queue by
least possible distance. Inside a page, entries whose stored parent distance
already rules them out by the triangle inequality
|d(q, parent) - d(entry, parent)| - radius > bound are skipped without
computing their distance. Leaf scores are integer inner products, and bounds
carry a slack for rounding, so the result is exact.

Defined cases: see ``vectors``; a query with fewer candidates than k gets all
of them; ties go to the smaller vec_id.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
from pyspark.sql import DataFrame

from strata.llm import vectors as vs

PAGE = 256
SCALE = 256


class Tree:
    """Pages in arrays. Page p holds entries[lo[p]:hi[p]]; entry arrays:
    object, radius, distance to the page's parent object, child page (-1: leaf)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, page: int = PAGE):
        self.ids, self.x = ids, x
        self._derive()
        self.obj, self.radius, self.parent, self.child = [], [], [], []
        self.lo, self.hi = [], []
        self.root = self._page(np.arange(len(ids)), None, page)
        for name in ("obj", "radius", "parent", "child", "lo", "hi"):
            setattr(self, name, np.array(getattr(self, name)))

    def _derive(self):
        norm = (self.x * self.x).sum(1)
        self.most = int(norm.max()) if len(norm) else 0
        self.full = np.concatenate([self.x, np.sqrt(self.most - norm)[:, None]], 1)
        self.square = (self.full * self.full).sum(1)

    def __getstate__(self):
        state = {k: v for k, v in self.__dict__.items() if k not in ("full", "square")}
        small = self.x.astype(np.int16)
        state["x"] = small if np.array_equal(small, self.x) else self.x
        return state

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.x = self.x.astype(np.float64)
        self._derive()

    def _dist(self, a: np.ndarray, b: int) -> np.ndarray:
        d = self.square[a] + self.square[b] - 2 * (self.full[a] @ self.full[b])
        return np.sqrt(np.maximum(d, 0))

    def _page(self, members: np.ndarray, parent: int | None, page: int) -> int:
        """Store the members' page (and its subtree); returns its number."""
        to_parent = self._dist(members, parent) if parent is not None else np.zeros(len(members))
        if len(members) <= page:
            entries = [(int(m), 0.0, float(d), -1) for m, d in zip(members, to_parent)]
        else:
            parts, centres = self._split(members, min(page, -(-len(members) // page)))
            back = dict(zip(members.tolist(), to_parent.tolist()))
            entries = []
            for c, group in zip(centres, parts):
                child = self._page(group, c, page)
                entries.append((c, float(self._dist(group, c).max()), back[c], child))
        me = len(self.lo)
        self.lo.append(len(self.obj))
        for o, r, d, c in entries:
            self.obj.append(o)
            self.radius.append(r)
            self.parent.append(d)
            self.child.append(c)
        self.hi.append(len(self.obj))
        return me

    def _split(self, members: np.ndarray, fan: int):
        """Routing objects far from each other; members go to the nearest.
        Identical members are dealt evenly."""
        centres = [int(members[0])]
        near = self._dist(members, centres[0])
        owner = np.zeros(len(members), np.int64)
        while len(centres) < fan and near.max() > 1e-6:
            c = int(members[int(near.argmax())])
            d = self._dist(members, c)
            closer = d < near
            owner[closer] = len(centres)
            near = np.minimum(near, d)
            centres.append(c)
        if len(centres) == 1:                             # all members coincide
            parts = np.array_split(members, fan)
            return parts, [int(p[0]) for p in parts]
        parts = [members[owner == j] for j in range(len(centres))]
        return parts, centres

    def search(self, own: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, vec_id) of the k best for q, the row ``own`` left out."""
        if len(self.ids) == 0:
            return []
        qq = float(q @ q)
        slack = 1e-6 * (1.0 + qq + self.most)
        full_q = np.append(q, 0.0)
        best: list[tuple[int, int]] = []                  # heap of (score, -id)
        bound = np.inf                                    # squared distance of the k-th
        queue = [(0.0, 0, self.root, -1.0)]
        ticket = 0
        while queue:
            least, _, p, to_parent = heapq.heappop(queue)
            if least * least > bound + slack:
                break
            e = np.arange(self.lo[p], self.hi[p])
            if to_parent >= 0:
                gap = np.abs(to_parent - self.parent[e]) - self.radius[e]
                e = e[np.maximum(gap, 0) ** 2 <= bound + slack]
                if len(e) == 0:
                    continue
            o = self.obj[e]
            if self.child[e[0]] < 0:                      # leaf
                score = (self.x[o] @ q).astype(np.int64)
                if len(best) == k:
                    good = score >= best[0][0]
                    o, score = o[good], score[good]
                for s, i in zip(score.tolist(), self.ids[o].tolist()):
                    if i == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                if len(best) == k:
                    bound = qq + self.most - 2.0 * best[0][0]
                continue
            d = np.sqrt(np.maximum(self.square[o] + qq - 2 * (self.full[o] @ full_q), 0))
            low = np.maximum(d - self.radius[e], 0)
            ok = low * low <= bound + slack
            for l, c, dist in zip(low[ok].tolist(), self.child[e[ok]].tolist(), d[ok].tolist()):
                ticket += 1
                heapq.heappush(queue, (l, ticket, c, dist))
        return [(s, -i) for s, i in best]


def integer_vectors(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(scale * x)


def top_inner_products(vectors: DataFrame, is_query, k: int = 5, scale: int = SCALE,
                       page: int = PAGE, id_col: str = "vec_id", vec_col: str = "embedding",
                       shard_rows: int = vs.SHARD_ROWS) -> DataFrame:
    """Each query's k largest integer inner products over all other rows:
    (query_id, rank, vec_id, score). ``is_query(column)`` marks query ids."""
    def build(ids, x):
        return pickle.dumps(Tree(ids, integer_vectors(x, scale), page), protocol=5)

    def find(image, q_ids, q):
        tree: Tree = pickle.loads(image)
        at, vec, score = [], [], []
        for j, (i, row) in enumerate(zip(q_ids.tolist(), integer_vectors(q, scale))):
            for s, v in tree.search(i, row, k):
                at.append(j)
                vec.append(v)
                score.append(s)
        return at, vec, score

    return vs.search(vectors, build, find, k, "long", is_query, id_col, vec_col, shard_rows)
