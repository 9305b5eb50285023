"""Session construction and lineage cutting.

Cluster settings (shuffle partitions, checkpoint dir, memory) come from the
session the caller hands in; ``build_session`` only fills defaults for local
runs and tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Defaults applied only when a setting is absent.
_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata") -> SparkSession:
    """Create (or reuse) a session with UTC time, ANSI, AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system path). Only a local
    master -- local runs and tests -- gets a fresh scratch folder when it is
    unset; any other master raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def materialize(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage by writing a Parquet table in the shared checkpoint folder.

    Used before a chain of driver barriers (null fractions, medians, scaler
    moments) so each barrier re-reads the table instead of recomputing the
    whole plan. Parquet (rather than an RDD checkpoint of whole rows) lets
    every later read prune columns and push filters; the files survive
    executor loss (no local checkpoint).
    """
    import os
    import uuid
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    # zstd works in pooled heap buffers; snappy's direct ones stay until a collection
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*(partition_by or [])).parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.parquet(path)
    out._strata_stage = path
    return out


# Stage tables written by this process, per application.
_WRITTEN: dict[str, list[str]] = {}


def remove_stage(df: DataFrame) -> None:
    """Delete one stage table that ``materialize`` returned and nothing reads
    any more."""
    path = getattr(df, "_strata_stage", None)
    written = _WRITTEN.get(df.sparkSession.sparkContext.applicationId, [])
    if path in written:
        written.remove(path)
        _delete(df.sparkSession, [path])


def drop_stages(spark: SparkSession) -> int:
    """Delete the stage tables this application wrote (call when their results
    are no longer read); returns how many."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    _delete(spark, paths)
    return len(paths)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
