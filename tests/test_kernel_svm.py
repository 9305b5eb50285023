"""Cascade of the kernel SVM against a brute-force dual."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import kernel_svm as ks


def points(n, seed=3, d=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = np.where((x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + 0.4 * rng.normal(size=n)) > 0.6, 1.0, -1.0)
    return x, y


def brute_dual(x, y, c, gamma, rounds=6_000):
    """Accelerated projected gradient on the whole dual, with the projection
    on box and hyperplane found by bisection."""
    q = ks.rbf(x, x, gamma) * y[:, None] * y
    rate = 1.0 / np.linalg.eigvalsh(q)[-1]

    def project(z):
        lo, hi = -1e4, 1e4
        for _ in range(80):
            mid = (lo + hi) / 2
            if (y * np.clip(z - mid * y, 0, c)).sum() > 0:
                lo = mid
            else:
                hi = mid
        return np.clip(z - hi * y, 0, c)

    a = z = np.zeros(len(y))
    t = 1.0
    for k in range(rounds):
        new = project(z - rate * (q @ z - 1))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - a)
        if k % 200 == 0 and np.abs(new - a).max() < 1e-9:
            break
        a, t = new, t2
    return a


def frame(spark, x, y, c, parts, problem=0):
    rows = [(problem, i % parts, i, float(y[i]), float(c[i]), 0.0, 0.0, x[i].tolist()) for i in range(len(y))]
    return spark.createDataFrame(rows, ks.ROWS)


def balanced(y, c0):
    return np.where(y > 0, c0 * len(y) / (2 * (y > 0).sum()), c0 * len(y) / (2 * (y < 0).sum()))


def test_local_solver_matches_brute_force():
    x, y = points(160)
    c, gamma = balanced(y, 1.0), 0.25
    a, b = ks.solve_dual(x, y, c, np.zeros(len(y)), gamma, 1e-6)
    want = brute_dual(x, y, c, gamma)
    k = ks.rbf(x, x, gamma)
    value = lambda v: v.sum() - 0.5 * (v * y) @ k @ (v * y)
    assert abs((a * y).sum()) < 1e-9 and (a >= 0).all() and (a <= c).all()
    assert value(a) == pytest.approx(value(want), rel=1e-6)
    assert np.abs(k @ (a * y) - k @ (want * y)).max() < 1e-3


def test_cascade_reaches_the_optimum_of_all_rows(spark):
    x, y = points(500)
    gamma, parts = 0.25, 4
    c1, c10 = balanced(y, 1.0), balanced(y, 10.0)
    rows = frame(spark, x, y, c1, parts, 0).union(frame(spark, x, y, c10, parts, 1))
    vectors = ks.cascade(rows, gamma, parts)
    got = ks.decision_values(rows, vectors, gamma, parts).collect()
    for problem, c in ((0, c1), (1, c10)):
        f = np.zeros(len(y))
        for r in got:
            if r["problem"] == problem:
                f[r["id"]] = r["decision"]
        a, b = ks.solve_dual(x, y, c, np.zeros(len(y)), gamma, 1e-7)       # itself held against brute force above
        want = ks.rbf(x, x, gamma) @ (a * y) + b
        assert np.abs(f - want).max() < 0.02 * max(1.0, np.abs(want).max())
        assert (np.sign(f) != np.sign(want)).sum() <= 2
    for r in ks.duality_gap(rows, vectors, gamma, parts).collect():
        assert 0 <= r["primal"] - r["dual"] < 0.01 * r["primal"]


def test_one_class_duplicates_and_repeated_ids(spark):
    x, y = points(40)
    one = frame(spark, x, np.ones(40), np.ones(40), 3)
    got = ks.decision_values(one, ks.cascade(one, 0.3, 3), 0.3, 3)
    assert {r["decision"] for r in got.collect()} == {1.0}
    same = np.repeat(x[:4], 10, axis=0)                           # equal rows, both labels
    y2 = np.tile([1.0, -1.0], 20)
    f = [r["decision"] for r in ks.decision_values(frame(spark, same, y2, np.ones(40), 2),
                                                   ks.cascade(frame(spark, same, y2, np.ones(40), 2), 0.3, 2), 0.3, 2).collect()]
    assert np.abs(f).max() < 1.0 + 1e-6


def test_grid_search_calibrates_on_unseen_folds(spark):
    x, y = points(400, 8)
    df = spark.createDataFrame([(i, int(y[i] > 0), i % 4, x[i].tolist()) for i in range(400)],
                               "id long, label int, fold int, x array<double>")
    model = ks.fit(df, (0.1, 1.0, 10.0), folds=4, part_rows=150)
    assert model.parts == 3 and model.c == max(model.cv_f1, key=lambda c: (model.cv_f1[c], -c))
    tx, ty = points(300, 99)
    test = spark.createDataFrame([(i, "spare", tx[i].tolist()) for i in range(300)], "pid long, spare string, f array<double>")
    out = {r["pid"]: r for r in model.transform(test, "pid", F.col("f")).collect()}
    assert len(out) == 300 and out[0]["spare"] == "spare"
    right = np.mean([out[i]["prediction"] == (ty[i] > 0) for i in range(300)])
    assert right > 0.75
    p = np.array([out[i]["probability"][1] for i in range(300)])
    d = np.array([out[i]["decision"] for i in range(300)])
    assert (np.argsort(p) == np.argsort(d)).mean() > 0.9 and ((p > 0) & (p < 1)).all()
    # calibrated: mean probability near the share of positives
    assert abs(p.mean() - (ty > 0).mean()) < 0.08


def test_part_solved_in_blocks():
    """More rows than a block: the same optimum as in one block, from any
    feasible start, with equal rows of both classes among them."""
    x, y = points(700, 5)
    x[:40], y[:40] = x[40:80], -y[40:80]
    c, gamma = balanced(y, 10.0), 0.25
    want, b = ks.solve_dual(x, y, c, np.zeros(700), gamma, 1e-5)
    k = ks.rbf(x, x, gamma)
    value = lambda v: v.sum() - 0.5 * (v * y) @ k @ (v * y)
    for start in (np.zeros(700), want, c):
        a, off = ks.solve_dual(x, y, c, start, gamma, 1e-4, working=64)
        assert abs((a * y).sum()) < 1e-7 and (a >= 0).all() and (a <= c).all()
        assert value(a) == pytest.approx(value(want), rel=1e-6) and off == pytest.approx(b, abs=1e-3)
        assert np.abs(k @ (a * y) - k @ (want * y)).max() < 2e-3


def test_every_part_is_a_task(spark):
    """Parts of all problems are solved side by side, whatever their size."""
    x, y = points(300)
    rows = frame(spark, x, y, balanced(y, 1.0), 2, 0)
    for p in range(1, 5):
        rows = rows.union(frame(spark, x, y, balanced(y, 1.0 + p), 2, p))
    solved = ks._solved(rows, 5, 2, 0.25, 1e-3).withColumn("task", F.spark_partition_id())
    got = {r["task"]: (r["problem"], r["part"]) for r in solved.select("task", "problem", "part").distinct().collect()}
    assert len(got) == 10 and got[0][0] == 4 and len(set(got.values())) == 10
