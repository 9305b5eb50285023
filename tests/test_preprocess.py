import math

from pyspark.sql import functions as F

from strata.operators import preprocess as pp


def test_sparse_rule_boundary():
    fr = {"half": 0.5, "more": 0.51, "less": 0.2}
    assert pp.sparse_columns(fr) == ["more"]                              # canonical: > 0.5
    assert sorted(pp.sparse_columns(fr, inclusive=True)) == ["half", "more"]   # variant keeps < 0.5


def test_median_interpolates_and_ignores_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert pp.column_medians(df, ["x"]) == {"x": 2.5}
    imputed = pp.impute(df, {"x": 2.5})
    assert sorted(r[0] for r in imputed.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]


def test_mode_smallest_among_ties(spark):
    long = spark.createDataFrame([("f", v) for v in (2.0, 2.0, 1.0, 1.0, 3.0)], "feature string, value double")
    assert [(r["mode"], r["count"]) for r in pp.column_modes(long).collect()] == [(1.0, 2)]


def test_split_counts_match_published_shape(spark):
    for n, pos, test_n, test_pos in ((2152, 103, 431, 21), (1975, 98, 395, 20)):
        df = spark.range(n).select(F.col("id").alias("PATIENT"),
                                   (F.col("id") < pos).cast("int").alias("label"))
        s = pp.stratified_split(df)
        got = {(r["split"], r["label"]): r["n"] for r in
               s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert got[("test", 0)] + got[("test", 1)] == test_n
        assert got[("test", 1)] == test_pos
        assert got[("train", 0)] + got[("train", 1)] == n - test_n   # disjoint and exhaustive


def test_folds_are_stratified(spark):
    df = spark.range(1000).select(F.col("id").alias("PATIENT"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    f = pp.fold_assignment(df, 5)
    sizes = {(r["fold"], r["label"]): r["n"] for r in f.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {sizes[(k, 1)] for k in range(5)} == {20} and {sizes[(k, 0)] for k in range(5)} == {180}


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "a double, c double")
    params = pp.scaler_params(df, ["a", "c"])
    out = sorted(tuple(r) for r in pp.apply_scaler(df, params).collect())
    s = math.sqrt(1.5)
    assert [round(x[0], 4) for x in out] == [round(-1 / math.sqrt(2 / 3), 4), 0.0, round(1 / math.sqrt(2 / 3), 4)]
    assert {x[1] for x in out} == {0.0}
    assert round(s, 4) == 1.2247


def test_align_adds_zero_columns(spark):
    df = spark.createDataFrame([("p", 1, 2.0, 3.0)], "PATIENT string, label int, a double, extra double")
    out = pp.align_columns(df, ["b", "a"])
    assert out.columns == ["PATIENT", "label", "b", "a"] and tuple(out.first()) == ("p", 1, 0.0, 2.0)


def test_class_allocation_by_largest_remainder(spark):
    """ceil(0.2 n) test rows for every class mix, each class within one row of
    its share; ties to the smaller label."""
    import math

    from strata.operators.preprocess import class_allocation
    mixes = [(12, 12), (107, 12), (1, 1), (3, 0), (1000, 1), (7, 7, 7), (2, 3, 5, 8, 13), (86, 2066)]
    rows = [(g, c, n) for g, mix in enumerate(mixes) for c, n in enumerate(mix) if n]
    sizes = spark.createDataFrame(rows, "g int, label int, _nc long")
    got = {(r["g"], r["label"]): r["_ntest"] for r in class_allocation(sizes, 0.2, "label", ["g"]).collect()}
    for g, mix in enumerate(mixes):
        total, want = sum(mix), math.ceil(0.2 * sum(mix))
        mine = [got.get((g, c), 0) for c in range(len(mix))]
        assert sum(mine) == want
        assert all(abs(m - n * want / total) < 1 for m, n in zip(mine, mix))
    assert [got[0, c] for c in (0, 1)] == [3, 2] and [got[1, c] for c in (0, 1)] == [22, 2]
    one = {r["label"]: r["_ntest"] for r in class_allocation(sizes.filter("g = 1").drop("g"), 0.2).collect()}
    assert one == {0: 22, 1: 2}
