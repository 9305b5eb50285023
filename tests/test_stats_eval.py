import math

from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.operators import stats as sx


def test_corr_constant_is_null_and_last(spark):
    rows = [("const", 1.0, 0), ("const", 1.0, 1), ("x", 1.0, 0), ("x", 2.0, 1)]
    long = spark.createDataFrame(rows, "feature string, value double, label int")
    top = sx.top_by_abs_corr(sx.corr_with_label(long), 2).collect()
    assert [r["feature"] for r in top] == ["x", "const"] and top[1]["r"] is None
    assert abs(top[0]["r"] - 1.0) < 1e-12


def test_histogram_last_bin_closed(spark):
    long = spark.createDataFrame([("f", v) for v in (0.0, 1.0, 2.0, 4.0)], "feature string, value double")
    h = sx.histogram(long, 4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 1, 1, 1]
    assert abs(sum(r["density"] * (r["bin_hi"] - r["bin_lo"]) for r in h) - 1.0) < 1e-12


def test_kde_integrates_to_one(spark):
    long = spark.createDataFrame([("f", float(v)) for v in (0, 1, 1, 2, 3, 5, 8)], "feature string, value double")
    k = sx.kde_curve(long, points=1000).orderBy("k").collect()
    step = k[1]["x"] - k[0]["x"]
    assert abs(sum(r["density"] for r in k) * step - 1.0) < 0.02


def test_box_stats_whiskers_and_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    long = spark.createDataFrame([("f", v) for v in vals], "feature string, value double")
    b = sx.box_stats(long).first()
    assert (b["q1"], b["median"], b["q3"]) == (2.0, 3.0, 4.0)
    assert (b["whisker_lo"], b["whisker_hi"], b["n_outliers"]) == (1.0, 4.0, 1)


def test_metrics_zero_division(spark):
    pred = spark.createDataFrame([(1, 0, 0.2), (0, 0, 0.1)], "label int, prediction int, score double")
    m = ev.binary_metrics(pred).first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_auc_ties_half(spark):
    pred = spark.createDataFrame([(1, 1, 0.5), (0, 1, 0.5)], "label int, prediction int, score double")
    assert ev.roc_auc(pred).first()["roc_auc"] == 0.5


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(400).select(
        (F.col("id") % 7 < 2).cast("int").alias("label"),
        (F.round(F.rand(3) * 0.5 + (F.col("id") % 7 < 2).cast("double") * 0.3, 2)).alias("score"))
    ours = ev.roc_auc(df).first()["roc_auc"]
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert abs(ours - ref) < 1e-6


def test_roc_points_end_at_one(spark):
    pred = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.8), (1, 0, 0.4), (0, 0, 0.1)],
                                 "label int, prediction int, score double")
    pts = sorted((r["fpr"], r["tpr"]) for r in ev.roc_points(pred, drop_intermediate=False).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0) and len(pts) == 5


def test_kde_equals_the_direct_sum(spark):
    """The Gauss transform stays within 1e-9 of the sum over all values, also
    for far outliers, equal values and grids finer or coarser than h."""
    import numpy as np
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(size=900), "b": np.concatenate([rng.normal(size=200), [60.0, 61.0]]),
            "c": rng.integers(0, 4, 300).astype(float), "d": np.array([1e6, 1e6 + 1, 1e6 + 3])}
    long = spark.createDataFrame([(f, float(v)) for f, vs in data.items() for v in vs] + [("e", 1.0), ("g", 2.0), ("g", 2.0)],
                                 "feature string, value double").repartition(4)
    for points, cut in ((1000, None), (100, 0.0), (17, 2.0)):
        got = sx.kde_curve(long, points=points, cut=cut).collect()
        assert {r["feature"] for r in got} == set(data) and len(got) == points * len(data)
        for r in got:
            v = data[r["feature"]]
            h = v.std(ddof=1) * len(v) ** -0.2
            want = np.exp(-0.5 * ((r["x"] - v) / h) ** 2).sum() / (len(v) * h * np.sqrt(2 * np.pi))
            assert abs(r["density"] - want) < 1e-9


def test_pairwise_complete_correlation_equals_pandas(spark, monkeypatch):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) + 1e6
    x[:, 4] = 7.0                                              # constant
    x[rng.random(x.shape) < 0.3] = np.nan
    x[1:, 5] = np.nan                                          # one value
    frame = pd.DataFrame(x, columns=list("abcdef"))
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in "abcdef")).repartition(7)
    want = frame.corr()
    for kw in ({}, {"block": 13, "tree_width": 2}):
        got = sx.corr_matrix_lower(df, list("abcdef"), **kw).collect()
        assert [(r["i"], r["j"]) for r in got] == [(i, j) for i in range(6) for j in range(i)]
        for r in got:
            w = want.loc[r["feature_a"], r["feature_b"]]
            assert (r["r"] is None and np.isnan(w)) or abs(r["r"] - w) < 1e-9
    none = sx.corr_matrix_lower(df.filter("a < 0"), ["a", "b"]).collect()
    assert [r["r"] for r in none] == [None]
