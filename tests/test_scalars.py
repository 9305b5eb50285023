import datetime as dt

from pyspark.sql import functions as F

from strata.functions import scalars as fs


def test_ages(spark):
    df = spark.createDataFrame([(dt.date(1960, 1, 1),), (dt.date(2020, 1, 2),)], "b date")
    ref = F.to_date(F.lit("2020-01-01"))
    got = [(r[0], r[1]) for r in df.select(fs.age_years("b", ref), fs.age_floor_years("b", ref)).collect()]
    assert got[0] == (60.0, 60)
    assert got[1][0] == 0.0 and got[1][1] == -1      # -0.0 canonical; floor, not truncation


def test_sanitize_reproduces_published_name(spark):
    df = spark.createDataFrame([("Cholesterol [Mass/volume] in Serum or Plasma",)], "d string")
    name = df.select(F.concat(F.lit("obs_"), fs.sanitize_name("d"), F.lit("_mean"))).first()[0]
    assert name == "obs_Cholesterol__Mass_volume__in_Serum_or_Plasma_mean"
    v = df.select(fs.sanitize_name_truncated("d", 40)).first()[0]
    assert v == "Cholesterol__Mass_volume__in_Serum_or_Pl" and len(v) == 40


def test_label_regex(spark):
    df = spark.createDataFrame([("Asthma (disorder)",), ("Fever (finding)",), ("disorder",), (None,)],
                               "d string")
    got = [r[0] for r in df.select(fs.matches_flag("d", r"\(disorder\)|\(finding\)").cast("int")).collect()]
    assert got == [1, 1, 0, 0]


def test_delta_pct_zero_guard(spark):
    df = spark.createDataFrame([(2.0, 0.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(fs.delta_pct("a", "b")).collect()] == [None, 50.0]
