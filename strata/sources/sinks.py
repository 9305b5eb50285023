"""Writers (S9-S12): processed splits, statistics and metrics tables.

All writes are distributed (no coalesce(1) on data that grows); small
report tables may be written as one file with ``single_file=True``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Metrics table columns of the reference.
METRICS_SCHEMA = ("model string, accuracy double, precision double, recall double, "
                  "f1 double, roc_auc double, evaluated_on string")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    from strata.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


# A task keeps this many slices open before it sorts; each holds a row group.
OPEN_SLICES, SLICE_ROW_GROUP = 16, 8 << 20


def write_slices(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet partitioned by columns of few values. A task keeps one file per
    slice open, with small row groups, and so needs no sort of all its rows by
    slice; rows of slices beyond ``OPEN_SLICES`` are sorted as usual."""
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name, None)
    conf.set(name, OPEN_SLICES)
    try:
        (df.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", SLICE_ROW_GROUP)
         .partitionBy(*by).parquet(path))
    finally:
        conf.set(name, before) if before is not None else conf.unset(name)


def write_splits(df: DataFrame, path: str) -> None:
    """Prepared rows partitioned by cohort and split."""
    df.write.mode("overwrite").partitionBy("cohort", "split").parquet(path)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """Processed splits back, partition columns restored."""
    return spark.read.parquet(path)


def write_table_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Report tables as CSV with header."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metrics CSV with the fixed schema."""
    return spark.read.schema(METRICS_SCHEMA).option("header", True).csv(path)
