"""RBF-kernel support vector classifier (M2) solved in the dual.

    min over a   1/2 a' Q a - sum(a),   y'a = 0,   0 <= a_i <= C_i

with Q_ij = y_i y_j exp(-gamma |x_i - x_j|^2), C_i = C n / (2 n_class) and
gamma = 1 / (d var(X)).

The solution comes from a cascade. Rows are dealt by hash to parts of at most
about ``PART_BYTES`` of values; a task solves its part (blocks of the rows that
violate optimality most, in a block pairs of multipliers, the second by the
largest gain) and passes on its support vectors only; parts are merged two by two and solved again from the multipliers they bring, until one
is left. Its support vectors are then held against every row: while a pair of
rows violates the optimality condition by more than twice ``TOL``, the support
vectors and the ``WORST`` rows of either side go into all first parts and the
cascade runs again. Every pass raises the dual value, so it ends, at the
optimum of all rows.

Several problems (values of C and folds) run through one cascade together,
``problem`` being part of every group's key. Nothing is collected on the
driver but counts. Bound: the support vectors of one problem must fit a task
(8 (d + 5) bytes each); of the kernel a task holds ``WORKING`` rows squared.

Probabilities are Platt's sigmoid, fitted to decision values of rows that the
deciding model has not seen (the folds' models), with Platt's targets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

PART_BYTES = 48_000_000    # values of a part that one task solves
WORKING = 4096             # rows of a block of pairs: its kernel takes 134 MB
TOL = 1e-3
WORST = 200
ROWS = "problem int, part int, id long, y double, c double, alpha double, b double, x array<double>"


def rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    d = (-2 * a) @ b.T
    d += (a * a).sum(1)[:, None]
    d += (b * b).sum(1)
    np.maximum(d, 0, out=d)
    d *= -gamma
    return np.exp(d, out=d)


def _less_kernel(value: np.ndarray, x: np.ndarray, who: np.ndarray, weight: np.ndarray, gamma: float, kind) -> None:
    """``value -= K[:, who] weight`` in place, block by block, in precision ``kind``."""
    size = gamma * (x * x).sum(1)
    for i in range(0, len(who), 1024):
        mine, w = who[i:i + 1024], weight[i:i + 1024].astype(kind)
        # one product gives -gamma |a - b|^2
        right = np.ascontiguousarray(np.vstack([2 * gamma * x[mine].T, -size[mine], np.ones(len(mine))]).astype(kind))
        for at in range(0, len(x), 2048):
            left = np.column_stack([x[at:at + 2048], np.ones(len(x[at:at + 2048])), -size[at:at + 2048]]).astype(kind)
            k = left @ right
            np.minimum(k, 0, out=k)
            np.exp(k, out=k)
            value[at:at + 2048] -= k @ w


def _pairs(kernel: np.ndarray, s: np.ndarray, low: np.ndarray, high: np.ndarray, value: np.ndarray, tol: float,
           most: float = np.inf) -> None:
    """Pairs of signed multipliers moved in place, the second by the largest
    gain, until the violation is below tol or ``most`` steps are made."""
    steps = 0
    while steps < most:
        top = np.where(s < high, value, -np.inf)
        i = int(top.argmax())
        gap = top[i] - np.where(s > low, value, np.inf)
        if not gap.max(initial=-np.inf) >= tol or not np.isfinite(top[i]):
            break
        bend = np.maximum(2 - 2 * kernel[i], 1e-12)
        np.maximum(gap, 0, out=gap)
        j = int((gap * gap / bend).argmax())
        t = min(gap[j] / bend[j], high[i] - s[i], s[j] - low[j])
        s[i] = high[i] if t == high[i] - s[i] else min(s[i] + t, high[i])
        s[j] = low[j] if t == s[j] - low[j] else max(s[j] - t, low[j])
        value -= t * (kernel[i] - kernel[j])
        steps += 1


def _worst(top: np.ndarray, low: np.ndarray, n: int, kept: np.ndarray) -> np.ndarray:
    """Working set: ``kept``, and the worst rows of both sides in turn."""
    m = min(n, len(top) - 1)
    up, down = np.argpartition(-top, m)[:m], np.argpartition(low, m)[:m]
    up, down = up[np.argsort(-top[up])], down[np.argsort(low[down])]
    turns = np.stack([np.where(np.isfinite(top[up]), up, -1), np.where(np.isfinite(low[down]), down, -1)], 1).ravel()
    _, first = np.unique(turns, return_index=True)
    turns = turns[np.sort(first)]
    return np.concatenate([kept, turns[(turns >= 0) & ~np.isin(turns, kept)]])[:n]


def solve_dual(x: np.ndarray, y: np.ndarray, c: np.ndarray, alpha: np.ndarray, gamma: float,
               tol: float = TOL, working: int = WORKING) -> tuple[np.ndarray, float]:
    """(multipliers, offset) from a feasible start, to a violation below tol.

    Up to ``working`` rows are solved as one block. Of more rows, the worst and
    half of the last new ones are solved as a block at a time, and the rows
    whose multiplier changed are taken off every row's value, so no kernel
    rows are stored. That step is in single precision; before the end the
    values are computed anew in double precision, and the work goes on if
    they show a violation."""
    s, value = alpha * y, y.astype(np.float64)
    low, high = np.where(y > 0, 0.0, -c), np.where(y > 0, c, 0.0)
    if len(y) <= working:
        kernel = rbf(x, x, gamma)
        value -= kernel @ s
        _pairs(kernel, s, low, high, value, tol)
    else:
        some = np.flatnonzero(s)
        _less_kernel(value, x, some, s[some], gamma, np.float32)
        exact, last = not len(some), np.zeros(0, np.int64)
        while True:
            top, end = np.where(s < high, value, -np.inf), np.where(s > low, value, np.inf)
            gap = top.max() - end.min()
            if not gap >= tol or not np.isfinite(gap):
                if exact:
                    break
                some, value = np.flatnonzero(s), y.astype(np.float64)
                _less_kernel(value, x, some, s[some], gamma, np.float64)
                exact = True
                continue
            kept = last[:working // 2]
            rows = _worst(top, end, working, kept)
            last = rows[len(kept):]
            mine = s[rows]
            _pairs(rbf(x[rows], x[rows], gamma), mine, low[rows], high[rows], value[rows], max(tol / 2, 0.02 * gap),
                   50 * working)
            moved = np.flatnonzero(mine != s[rows])
            _less_kernel(value, x, rows[moved], (mine - s[rows])[moved], gamma, np.float32)
            s[rows] = mine
            exact = False
    alpha = np.abs(s)
    free = (alpha > 0) & (alpha < c)
    if free.any():
        return alpha, float(value[free].mean())
    ends = [v for v in (np.max(value, where=s < high, initial=-np.inf), np.min(value, where=s > low, initial=np.inf))
            if np.isfinite(v)]
    return alpha, float(np.mean(ends)) if ends else 0.0


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    out = {c: np.asarray(table.column(c)) for c in ("id", "y", "c", "alpha", "b")}
    flat = np.concatenate([np.asarray(k.flatten(), np.float64) for k in table.column("x").chunks] or [np.zeros(0)])
    out["x"] = flat.reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 0))
    return out


def _table(problem: int, part: int, rows: dict[str, np.ndarray], keep: np.ndarray, b: float) -> pa.Table:
    n = len(keep)
    return pa.table({"problem": pa.array([problem] * n, pa.int32()), "part": pa.array([part] * n, pa.int32()),
                     "id": pa.array(rows["id"][keep], pa.int64()),
                     **{k: pa.array(rows[k][keep], pa.float64()) for k in ("y", "c", "alpha")},
                     "b": pa.array([b] * n, pa.float64()),
                     "x": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * rows["x"].shape[1], pa.int32()),
                                                   pa.array(rows["x"][keep].ravel()))})


def _solve_parts(gamma: float, tol: float):
    """Task: solve the parts of its partition, keep their support vectors (one
    row at least of each, which carries the offset)."""
    def solve(problem, part, rows):
        order = np.lexsort((-rows["alpha"], rows["id"]))         # of a row that came twice, the one with a multiplier
        rows = {k: v[order] for k, v in rows.items()}
        first = np.ones(len(order), bool)
        first[1:] = rows["id"][1:] != rows["id"][:-1]
        rows = {k: v[first] for k, v in rows.items()}
        alpha = _feasible(rows["y"], rows["alpha"])
        rows["alpha"], b = solve_dual(rows["x"], rows["y"], rows["c"], alpha, gamma, tol)
        keep = np.flatnonzero(rows["alpha"] > 0)
        return _table(problem, part, rows, keep if len(keep) else np.arange(1), b)

    def task(batches):
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        group = np.stack([np.asarray(table.column("problem")), np.asarray(table.column("part"))], 1)
        rows = _columns(table)
        del table
        for key in np.unique(group, axis=0):
            mine = np.flatnonzero((group == key).all(1))
            yield from solve(int(key[0]), int(key[1]), {k: v[mine] for k, v in rows.items()}).to_batches()
    return task


def _solved(level: DataFrame, problems: int, parts: int, gamma: float, tol: float) -> DataFrame:
    """Support vectors of every part. A part is a partition of its own - left
    to a hash and to the sizes of partitions, tasks would get several - and the
    last problems, those of the largest limits, start first."""
    place = ((F.lit(problems - 1) - F.col("problem")) * F.lit(parts) + F.col("part")).cast("int")
    return level.repartitionById(problems * parts, place).mapInArrow(_solve_parts(gamma, tol), ROWS)


def _feasible(y: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Multipliers scaled down on the heavier side so that y'a = 0."""
    up, down = alpha[y > 0].sum(), alpha[y < 0].sum()
    if up == down:
        return alpha
    if min(up, down) == 0:
        return np.zeros_like(alpha)
    return np.where(y > 0, alpha * min(1.0, down / up), alpha * min(1.0, up / down))


def _decide(gamma: float):
    """Cogroup task: decision values of the rows of a part by the support
    vectors of its problem."""
    def decide(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"problem": pa.array([], pa.int32()), "id": pa.array([], pa.int64()),
                             "y": pa.array([], pa.float64()), "c": pa.array([], pa.float64()),
                             "decision": pa.array([], pa.float64())})
        rows, model = _columns(left), _columns(right)
        weight, f = model["alpha"] * model["y"], np.empty(left.num_rows)
        step = max(1, 4_000_000 // len(weight))
        for at in range(0, len(f), step):
            f[at:at + step] = rbf(rows["x"][at:at + step], model["x"], gamma) @ weight
        return pa.table({"problem": pa.array([key[0].as_py()] * len(f), pa.int32()), "id": pa.array(rows["id"], pa.int64()),
                         "y": pa.array(rows["y"], pa.float64()), "c": pa.array(rows["c"], pa.float64()),
                         "decision": pa.array(f + model["b"][0], pa.float64())})
    return decide


DECIDED = "problem int, id long, y double, c double, decision double"


def decision_values(rows: DataFrame, vectors: DataFrame, gamma: float, parts: int) -> DataFrame:
    """(problem, id, y, c, decision) of rows (``ROWS``) by each problem's
    support vectors, which go to every part."""
    spread = vectors.drop("part").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))) \
        .select(*[c.split()[0] for c in ROWS.split(", ")])
    return rows.groupBy("problem", "part").cogroup(spread.toDF(*spread.columns).groupBy("problem", "part")) \
        .applyInArrow(_decide(gamma), DECIDED)


def cascade(rows: DataFrame, gamma: float, parts: int, tol: float = TOL) -> DataFrame:
    """Support vectors (``ROWS``) of every problem at the optimum over all its
    rows; ``rows`` is a written table of ``ROWS`` with alpha 0."""
    names = [c.split()[0] for c in ROWS.split(", ")]
    first, done = rows, None
    problems = (rows.agg(F.max("problem")).first()[0] or 0) + 1
    while True:
        level, left = first, parts
        while True:
            level = materialize(_solved(level, problems, left, gamma, tol), "svm")
            if left == 1:
                break
            left = -(-left // 2)
            level = level.withColumn("part", F.floor(F.col("part") / 2).cast("int"))
        if parts == 1:                                   # one part held every row
            return level if done is None else done.unionByName(level)
        open_rows = rows if done is None else rows.join(level.select("problem").distinct(), "problem", "left_semi")
        alpha = level.filter("alpha > 0").select("problem", "id", "alpha")
        held = materialize(decision_values(open_rows, level, gamma, parts).join(alpha, ["problem", "id"], "left")
                           .withColumn("value", F.col("y") - F.col("decision"))
                           .withColumn("alpha", F.coalesce("alpha", F.lit(0.0))), "svm-held")
        rise = F.when(F.col("y") > 0, F.col("alpha") < F.col("c")).otherwise(F.col("alpha") > 0)
        fall = F.when(F.col("y") > 0, F.col("alpha") > 0).otherwise(F.col("alpha") < F.col("c"))
        worst = held.groupBy("problem").agg(F.max(F.when(rise, F.col("value"))).alias("top"),
                                            F.min(F.when(fall, F.col("value"))).alias("low")) \
            .filter(F.col("top") - F.col("low") > 2 * tol).select("problem")
        again = materialize(worst, "svm-open")
        settled = level.join(again, "problem", "left_anti")
        done = settled if done is None else done.unionByName(settled)
        if again.isEmpty():
            return materialize(done, "svm-vectors")
        # every part gets the support vectors and the worst rows of either side, so one part at
        # least holds the pair that violates most and improves on the solution
        up = Window.partitionBy("problem").orderBy(F.col("value").desc(), "id")
        down = Window.partitionBy("problem").orderBy("value", "id")
        idle = held.filter("alpha = 0").join(again, "problem", "left_semi")
        pairs = idle.filter("y > 0").withColumn("r", F.row_number().over(up)).filter(F.col("r") <= WORST) \
            .unionByName(idle.filter("y < 0").withColumn("r", F.row_number().over(down)).filter(F.col("r") <= WORST))
        shared = materialize(level.filter("alpha > 0").join(again, "problem", "left_semi").select(*names).unionByName(
            rows.join(pairs.select("problem", "id"), ["problem", "id"], "left_semi").select(*names)), "svm-shared")
        back = shared.drop("part").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(*names)
        first = rows.join(again, "problem", "left_semi").select(*names).unionByName(back)


def duality_gap(rows: DataFrame, vectors: DataFrame, gamma: float, parts: int) -> DataFrame:
    """(problem, primal, dual) of the solutions over all their rows."""
    d = decision_values(rows, vectors, gamma, parts)
    loss = d.groupBy("problem").agg(F.sum(F.col("c") * F.greatest(F.lit(0.0), 1 - F.col("y") * F.col("decision"))).alias("loss"))
    a = vectors.select("problem", "id", "alpha", "b")
    size = (d.join(a, ["problem", "id"]).groupBy("problem")
            .agg(F.sum(F.col("alpha") * F.col("y") * (F.col("decision") - F.col("b"))).alias("w2"),
                 F.sum("alpha").alias("total")))
    return size.join(loss, "problem").select("problem", (F.col("w2") / 2 + F.col("loss")).alias("primal"),
                                             (F.col("total") - F.col("w2") / 2).alias("dual"))


def problem_rows(base: DataFrame, problems: DataFrame, parts: int) -> DataFrame:
    """``ROWS`` of every problem: ``base`` (id, y of +-1, fold, x) without the
    problem's held fold, with balanced limits c."""
    # a handful of problems: (problem, c0, held); held null keeps every row
    p = F.broadcast(problems)
    mine = base.join(p, p["held"].isNull() | (p["held"] != base["fold"]))
    sizes = mine.groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") > 0).alias("pos"))
    same = F.when(F.col("y") > 0, F.col("pos")).otherwise(F.col("n") - F.col("pos"))
    return mine.join(F.broadcast(sizes), "problem").select(
        "problem", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", "y",
        (F.col("c0") * F.col("n") / (2 * same)).alias("c"), F.lit(0.0).alias("alpha"), F.lit(0.0).alias("b"), "x")


@dataclass
class KernelSvm:
    """A fitted classifier: support vectors (a written table), gamma, C, and
    the sigmoid of its decision values."""
    vectors: DataFrame
    gamma: float
    c: float
    parts: int
    sigmoid: LogisticRegressionModel | None
    cv_f1: dict[float, float]

    def decide(self, rows: DataFrame) -> DataFrame:
        """(id, decision) of rows (id, x)."""
        full = rows.select(F.lit(0).alias("problem"), F.pmod(F.xxhash64("id"), F.lit(self.parts)).cast("int").alias("part"),
                           F.col("id").cast("long").alias("id"), F.lit(1.0).alias("y"), F.lit(0.0).alias("c"),
                           F.lit(0.0).alias("alpha"), F.lit(0.0).alias("b"), "x")
        return decision_values(full, self.vectors, self.gamma, self.parts).select("id", "decision")

    def transform(self, df: DataFrame, id_col: str, x) -> DataFrame:
        """df with ``decision``, ``prediction`` (its sign) and ``probability``;
        ``x`` is the column expression of the features as an array."""
        got = self.decide(df.select(F.col(id_col).alias("id"), x.alias("x")).dropDuplicates(["id"]))
        out = df.join(got.withColumnRenamed("id", id_col), id_col)
        out = out.withColumn("_m", array_to_vector(F.array("decision")))
        if self.sigmoid is None:
            p = (F.col("decision") > 0).cast("double")
            out = out.withColumn("probability", array_to_vector(F.array(1 - p, p)))
        else:
            out = self.sigmoid.transform(out).drop("rawPrediction", "prediction")
        return out.drop("_m").withColumn("prediction", (F.col("decision") > 0).cast("double"))


def fit_sigmoid(unseen: DataFrame) -> LogisticRegressionModel | None:
    """Platt's sigmoid on (y of +-1, decision) of unseen rows: targets
    (n+ + 1) / (n+ + 2) and 1 / (n- + 2), written as weighted labels."""
    n = unseen.agg(F.count_if(F.col("y") > 0).alias("pos"), F.count_if(F.col("y") < 0).alias("neg")).first()
    if not n["pos"] or not n["neg"]:
        return None
    high, low = (n["pos"] + 1.0) / (n["pos"] + 2.0), 1.0 / (n["neg"] + 2.0)
    target = F.when(F.col("y") > 0, F.lit(high)).otherwise(F.lit(low))
    both = unseen.select(F.explode(F.array(
        F.struct(F.col("decision"), F.lit(1.0).alias("label"), target.alias("weight")),
        F.struct(F.col("decision"), F.lit(0.0).alias("label"), (1 - target).alias("weight")))).alias("r")).select(
        array_to_vector(F.array("r.decision")).alias("_m"), "r.label", "r.weight")
    return LogisticRegression(featuresCol="_m", labelCol="label", weightCol="weight", maxIter=100,
                              standardization=False).fit(both)


def fit(train: DataFrame, cs: tuple[float, ...], folds: int = 5, part_rows: int | None = None,
        tol: float = TOL) -> KernelSvm:
    """Grid search of C by the mean positive-class F1 over the folds of
    ``train`` (id, label 0/1, fold, x), then a fit on all rows. The sigmoid is
    fitted to the chosen C's decisions on the folds it has not seen.
    ``part_rows``: rows of a part, ``PART_BYTES`` of values by default."""
    spark = train.sparkSession
    base = materialize(train.select(F.col("id").cast("long").alias("id"),
                                    F.when(F.col("label") == 1, 1.0).otherwise(-1.0).alias("y"), "fold", "x"), "svm-rows")
    n = base.count()
    d = len(base.select("x").first()["x"])
    spread = base.select(F.explode("x").alias("v")).agg(F.var_pop("v")).first()[0]
    gamma = 1.0 / (d * spread) if spread else 1.0
    parts = max(1, -(-n // (part_rows or max(1, PART_BYTES // (8 * d)))))
    grid = [(k * folds + f, float(c), f) for k, c in enumerate(cs) for f in range(folds)]
    rows = materialize(problem_rows(base, spark.createDataFrame(grid, "problem int, c0 double, held int"), parts), "svm-grid")
    vectors = cascade(rows, gamma, parts, tol)
    # the held fold of every problem, judged by the problem's model
    held = base.join(F.broadcast(spark.createDataFrame(grid, "problem int, c0 double, held int")),
                     F.col("held") == F.col("fold")).select(
        "problem", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", "y", F.col("c0").alias("c"),
        F.lit(0.0).alias("alpha"), F.lit(0.0).alias("b"), "x")
    unseen = materialize(decision_values(held, vectors, gamma, parts), "svm-unseen")
    yes, said = F.col("y") > 0, F.col("decision") > 0
    counts = unseen.groupBy("problem").agg(F.count_if(yes & said).alias("tp"), F.count_if(yes != said).alias("wrong")).collect()
    f1 = {r["problem"]: 2.0 * r["tp"] / (2 * r["tp"] + r["wrong"]) if 2 * r["tp"] + r["wrong"] else 0.0 for r in counts}
    mean = {c: float(np.mean([f1.get(k * folds + f, 0.0) for f in range(folds)])) for k, c in enumerate(cs)}
    best = max(range(len(cs)), key=lambda k: (mean[cs[k]], -k))
    mine = unseen.filter(F.floor(F.col("problem") / folds) == best)
    last = spark.createDataFrame([(0, float(cs[best]), None)], "problem int, c0 double, held int")
    whole = materialize(problem_rows(base, last, parts), "svm-all")
    return KernelSvm(cascade(whole, gamma, parts, tol), gamma, cs[best], parts, fit_sigmoid(mine), mean)
