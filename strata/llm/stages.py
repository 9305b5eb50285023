"""Written intermediate tables and early release of finished shuffles."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from strata.session import materialize


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder, cut the lineage, and let Spark's
    cleaner drop the shuffle files of the plan that is no longer needed."""
    out = materialize(df, name)
    del df
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out
