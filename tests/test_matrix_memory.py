"""The feature matrix and the claim lines without tasks that hold everything."""
from functools import reduce

import pytest
from pyspark.sql import functions as F

from strata.operators import features as fe
from strata.sources import sinks


def test_sides_are_joined_a_few_at_a_time(spark):
    spine = spark.range(40).select(F.col("id").alias("PATIENT"))
    sides = [spark.range(k, 40, 1 + k % 3).select(F.col("id").alias("PATIENT"), (F.col("id") * k).alias(f"c{k}"))
             for k in range(11)]
    got = fe.join_sides(spine, sides, at_once=3)
    want = reduce(lambda a, b: a.join(b, "PATIENT", "left"), sides, spine)
    assert got.columns == want.columns
    assert sorted(got.collect()) == sorted(want.collect())
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") <= 3


@pytest.mark.parametrize("values", [3, 40])
def test_slices_need_no_sort_of_all_rows(spark, tmp_path, values):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    df = spark.range(2000).select("id", (F.col("id") % values).alias("s"))
    sinks.write_slices(df, str(tmp_path / "out"), ["s"])
    assert spark.conf.get(name, None) == before
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 2000 and got.filter(F.col("s") == F.col("id") % values).count() == 2000
    assert got.filter("s = 1").count() == df.filter("s = 1").count()
