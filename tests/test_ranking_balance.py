import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import balance as ba
from strata.operators.ranking import exact_prefix_sum, exact_quantiles, exact_row_number, md5_bucket


def _shuffled(spark, n=3000):
    # a repartition upstream: input order differs between recomputations
    return spark.range(n).repartition(7).select(
        "id", (F.col("id") % 3).alias("g"), (F.rand(11) * 100).alias("v"))


def test_row_number_matches_window(spark):
    df = _shuffled(spark)
    key = F.md5(F.col("id").cast("string"))
    for kwargs in ({}, {"bucket": md5_bucket(key)}):
        a = exact_row_number(df, [key, F.col("id")], ["g"], out="rn", **kwargs)
        b = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy(key, "id")))
        assert a.join(b, "id").filter("rn != rn2").count() == 0


def test_quantiles_match_percentile(spark):
    df = _shuffled(spark)
    q = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.99]).collect()}
    ref = {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.99]).alias("p")).collect()}
    for g, ps in ref.items():
        for p, v in zip([0.25, 0.5, 0.99], ps):
            assert abs(q[(g, p)] - v) < 1e-9


@pytest.mark.parametrize("bins,cell_rows", [(1024, 50_000), (4, 10), (3, 1)])
def test_quantiles_by_narrowing(spark, bins, cell_rows):
    """Heavy tails, many equal values, constants, infinities, one row, nulls:
    the same values however often the ranges are narrowed."""
    import numpy as np
    rng = np.random.default_rng(1)
    data = {"normal": rng.normal(size=400), "tails": np.exp(rng.normal(size=300) * 40), "same": np.full(100, 3.5),
            "few": rng.integers(0, 3, 500).astype(float), "one": np.array([7.0]), "wide": np.array([-1.7e308, 1.7e308, 0.0, 1.0]),
            "ends": np.array([-np.inf, -np.inf, 1.0, 2.0, np.inf, np.inf, np.inf]), "zeros": np.array([0.0, -0.0, 1e-320, 0.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("normal", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in
           exact_quantiles(df, ["g"], "v", probs, bins=bins, cell_rows=cell_rows).collect()}
    assert {g for g, _ in got} == set(data)
    for g, vs in data.items():
        s = np.sort(vs)
        for p in probs:
            k = p * (len(s) - 1)
            lo, hi = s[math.floor(k)], s[math.ceil(k)]
            want = lo if lo == hi else lo + (hi - lo) * (k - math.floor(k))
            both_nan = math.isnan(got[(g, p)]) and math.isnan(want)      # half way from -inf
            assert both_nan or got[(g, p)] == want or math.isclose(got[(g, p)], want, rel_tol=1e-12), (g, p)


def _points(spark, n=60, dim=4):
    return spark.range(n).select(F.col("id"), F.array(*[F.rand(100 + i) for i in range(dim)]).alias("vec"))


def test_knn_matches_brute_force(spark):
    pts = _points(spark)
    got = {(r["id"], r["rank"]): r["nbr_id"] for r in ba.knn_within(pts, 5).collect()}
    local = {r["id"]: r["vec"] for r in pts.collect()}
    for i, v in local.items():
        d = sorted((math.dist(v, w), j) for j, w in local.items() if j != i)[:5]
        assert [got[(i, k + 1)] for k in range(5)] == [j for _, j in d]


def test_smote_balances_and_stays_on_segments(spark):
    pts = _points(spark, 80, 3).withColumn("label", (F.col("id") < 12).cast("int"))
    out = ba.smote(pts, k=5)
    counts = {r["label"]: r["n"] for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts[0] == counts[1] == 68
    mino = [r["vec"] for r in pts.filter("label = 1").collect()]
    for r in out.filter("synthetic").limit(30).collect():
        # some pair (a, b) of minority points has the synthetic point on its segment
        ok = False
        for a in mino:
            for b in mino:
                ab = [y - x for x, y in zip(a, b)]
                den = sum(x * x for x in ab)
                if den == 0:
                    continue
                t = sum((p - x) * y for p, x, y in zip(r["vec"], a, ab)) / den
                if -1e-9 <= t <= 1 + 1e-9 and math.dist([x + t * y for x, y in zip(a, ab)], r["vec"]) < 1e-9:
                    ok = True
        assert ok


def test_knn_exact_on_a_shell(spark):
    # all points at the same distance from the centroid: one key cannot prune
    import math as m
    pts = [(i, [m.cos(2 * m.pi * i / 40), m.sin(2 * m.pi * i / 40)]) for i in range(40)]
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    got = {(r["id"], r["rank"]): r["nbr_id"] for r in ba.knn_within(df, 2).collect()}
    for i, _ in pts:   # the two adjacent points (equal distance: compare as a set)
        assert {got[(i, 1)], got[(i, 2)]} == {(i - 1) % 40, (i + 1) % 40}


@pytest.mark.parametrize("partitions", ["8", "200"])
def test_ranks_beyond_the_range_sampler(spark, partitions):
    """300,000 distinct keys with a spare column: every evaluation of a range
    exchange samples its own bounds, so ranks must come from one of them."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        n = 300_000
        df = (spark.range(n).repartition(7)
              .select(F.pmod(F.col("id") * 7919, F.lit(n)).alias("k"), F.lit(1).cast("long").alias("w"),
                      F.sha2(F.col("id").cast("string"), 256).alias("spare"), (F.col("id") % 2).alias("g")))
        ranked = exact_row_number(df, ["k"], out="rn")
        assert ranked.filter(F.col("rn") != F.col("k") + 1).count() == 0 and ranked.count() == n
        sums = exact_prefix_sum(df, ["k"], ["w"])
        assert sums.filter(F.col("w_cum") != F.col("k") + 1).count() == 0 and sums.count() == n
        values = df.select("g", (F.col("k") / 7.0).alias("v"))
        got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(values, ["g"], "v", [0.1, 0.5, 0.9]).collect()}
        for r in values.groupBy("g").agg(F.percentile("v", [0.1, 0.5, 0.9]).alias("p")).collect():
            for p, v in zip([0.1, 0.5, 0.9], r["p"]):
                assert abs(got[(r["g"], p)] - v) < 1e-6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_knn_over_several_blocks(spark):
    pts = _points(spark, 90)
    one = {(r["id"], r["rank"]): r["nbr_id"] for r in ba.knn_within(pts, 3).collect()}
    many = {(r["id"], r["rank"]): r["nbr_id"] for r in ba.knn_within(pts, 3, block_rows=16).collect()}
    assert one == many and len(one) == 270


def test_knn_prunes_clustered_points(spark):
    """Same rows as brute force, with ties and equal points, while most visits
    of points to other blocks are skipped."""
    import numpy as np
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 5)) * 20
    x = np.concatenate([c + rng.normal(size=(40, 5)) for c in centres] + [np.tile(centres[0], (15, 1)), rng.integers(0, 3, (60, 5))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x.astype(float))], "id long, vec array<double>")
    got = {(r["id"], r["rank"]): (r["nbr_id"], r["dist"]) for r in ba.knn_within(df, 4, block_rows=32).collect()}
    for i, v in enumerate(x):
        d = np.sqrt(((x - v) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:4]
        assert [got[(i, r + 1)] for r in range(4)] == [(j, d[j]) for j in order]
    made, every = ba.knn_visits(df, 4, block_rows=32)
    assert 0 < made < 0.35 * every
