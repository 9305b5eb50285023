import os

from pyspark.sql import functions as F

from strata.operators import models as mo
from strata.sources import sinks


def test_metrics_csv_roundtrip(spark):
    rows = [("DT", 0.71, 0.07, 0.43, 0.13, 0.61, "D1"), ("MLP", 0.98, 0.88, 0.7, 0.78, 0.9, "D2")]
    df = spark.createDataFrame(rows, sinks.METRICS_SCHEMA)
    path = sinks.scratch_path(spark, "metrics")
    sinks.write_table_csv(df, path, single_file=True)
    back = sinks.read_metrics_csv(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_tree_save_load_and_importance(spark):
    df = spark.range(200).select((F.col("id") % 2).cast("double").alias("label"),
                                 (F.col("id") % 2 * 3.0 + F.rand(1)).alias("a"), F.rand(2).alias("b"))
    data = mo.assemble(df, ["a", "b"])
    from pyspark.ml.classification import DecisionTreeClassifier, DecisionTreeClassificationModel
    m = DecisionTreeClassifier(labelCol="label", maxDepth=3, seed=42).fit(data)
    path = sinks.scratch_path(spark, "model")
    mo.save(m, path)
    back = DecisionTreeClassificationModel.load(path)
    assert back.numNodes == m.numNodes
    imp = dict(mo.importances(back, ["a", "b"]))
    assert imp["a"] > imp["b"]
