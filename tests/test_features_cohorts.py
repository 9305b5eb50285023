import datetime as dt

from pyspark.sql import functions as F

from strata.operators import cohorts as co
from strata.operators import features as fe


def test_sum_and_mean_null_semantics(spark):
    spine = spark.createDataFrame([("p1",), ("p5",)], "PATIENT string")
    enc = spark.createDataFrame([("e1", "p1", "A", None, None, None), ("e2", None, "A", 1.0, 1.0, 1.0)],
                                "Id string, PATIENT string, ENCOUNTERCLASS string, "
                                "BASE_ENCOUNTER_COST double, TOTAL_CLAIM_COST double, PAYER_COVERAGE double")
    agg = fe.aggregate_table(enc, fe.CANONICAL_SPECS["encounters"])
    out = {r["PATIENT"]: r for r in spine.join(agg, "PATIENT", "left").collect()}
    assert out["p1"]["total_claim_cost"] == 0.0 and out["p1"]["avg_base_encounter_cost"] is None
    assert out["p1"]["total_encounters"] == 1
    assert out["p5"]["total_claim_cost"] is None       # no rows -> missing after the left join
    assert agg.count() == 1                              # NULL key never grouped


def test_variance_of_singletons_is_null(spark):
    obs = spark.createDataFrame([("p1", "X", "5"), ("p2", "X", "2"), ("p2", "X", "4"),
                                 ("p2", "X", "n/a")], "PATIENT string, DESCRIPTION string, VALUE string")
    wide = fe.observation_features(obs, n_patients=2)
    got = {r["PATIENT"]: (r["obs_X_mean"], r["obs_X_var"]) for r in wide.collect()}
    assert got == {"p1": (5.0, None), "p2": (3.0, 2.0)}


def test_name_collisions_get_suffix():
    assert fe._dedupe_names([("a b", "a_b"), ("a/b", "a_b")]) == [("a b", "a_b"), ("a/b", "a_b_2")]


def test_cohort_flags(spark):
    enc = spark.createDataFrame([
        ("p1", dt.datetime(2019, 12, 31)), ("p1", dt.datetime(2020, 1, 1)),
        ("p2", dt.datetime(2020, 1, 1)), ("p6", None)], "PATIENT string, START timestamp_ntz")
    spine = spark.createDataFrame([("p1",), ("p2",), ("p6",)], "PATIENT string")
    f = co.cohort_flags(spine.join(co.encounter_bounds(enc), "PATIENT", "left"), "2020-01-01")
    got = {r["PATIENT"]: (r["in_d1"], r["in_d2"]) for r in f.collect()}
    assert got == {"p1": (True, True), "p2": (False, True), "p6": (False, False)}


def test_label_encode_codepoint_order(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("B",)], "G string")
    got = {r[0]: r[1] for r in fe.label_encode(df.withColumn("k", F.col("G")), ["G"]).select("k", "G").collect()}
    assert got == {"B": 0, "a": 2, "b": 3, None: 1}    # 'B' < 'Unknown' < 'a' < 'b'


def test_spine_preserved_by_matrix(spark):
    from strata.plans.workflow import labelled_matrix
    from tests.conftest import SF_SMALL
    m = labelled_matrix(spark, SF_SMALL, checkpoint=False)
    n = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert m.count() == n and m.select("PATIENT").distinct().count() == n


def test_variant_pivot_averages_truncation_collisions(spark):
    a, b = "A" * 40 + " x", "A" * 40 + " y"          # same first 40 sanitised characters
    obs = spark.createDataFrame([("p1", a, "1"), ("p1", b, "2"), ("p1", b, "4"), ("p2", a, "5")],
                                "PATIENT string, DESCRIPTION string, VALUE string")
    wide = fe.observation_features_variant(obs, min_fraction=0.05)
    key = "obs_" + "A" * 40
    got = {r["PATIENT"]: (r[f"{key}_mean"], r[f"{key}_var"]) for r in wide.collect()}
    # p1: mean of the two description means (1 and 3) -> 2, not the pooled 7/3;
    # std: only description b has two values (std sqrt 2) -> averaged alone
    assert got["p1"][0] == 2.0 and abs(got["p1"][1] - 2 ** 0.5) < 1e-12
    assert got["p2"] == (5.0, None)


def test_variant_demographics(spark):
    import datetime as dt
    p = spark.createDataFrame([("x", dt.date(2020, 1, 2), None, None, "b", "c", None, 1.0, 0.0)],
                              "Id string, BIRTHDATE date, DEATHDATE date, GENDER string, RACE string, "
                              "ETHNICITY string, MARITAL string, INCOME double, HEALTHCARE_COVERAGE double")
    r = fe.demographics(p, "2020-01-01", age_mode="variant", null_category="nan").first()
    assert r["age"] == -1.0 and r["is_deceased"] == 0 and r["GENDER"] == 0
