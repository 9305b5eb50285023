import datetime as dt

from pyspark.sql import functions as F

from strata.functions import parse as fp


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


def test_na_tokens(spark):
    got = _one(spark, ["NA", "null", "", "None", "x"], fp.null_na_tokens)
    assert got == [None, None, None, None, "x"]


def test_lenient_numbers_match_pandas_rules(spark):
    text = ["1d", "2f", "0x1p3", "NaN", " 3 ", "1e3", "1,5", "", ".5", "5.", "+7", "abc"]
    want = [None, None, None, None, 3.0, 1000.0, None, None, 0.5, 5.0, 7.0, None]
    assert _one(spark, text, fp.lenient_double) == want


def test_dayfirst_dates(spark):
    got = _one(spark, ["15-03-2019", "5-3-2019", "2019-03-15"], fp.dayfirst_timestamp)
    assert got == [dt.datetime(2019, 3, 15), dt.datetime(2019, 3, 5), None]


def test_offset_kept_as_naive_utc(spark):
    got = _one(spark, ["2019-03-15T10:00:00+02:00", "garbage"], fp.utc_naive_timestamp)
    assert got == [dt.datetime(2019, 3, 15, 8, 0), None]
