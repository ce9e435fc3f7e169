"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans were tuned with. They only affect speed, never results.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "fieldtally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the tuning above; extra settings override it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where driver and
    executors are one process.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="fieldtally-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder inside the shared one."""
    return f"{shared_dir(spark)}/fieldtally-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the storage layer for ``path``, whatever store it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def settle(df: DataFrame, name: str = "settled", by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and continue from those files.

    Later reads see the same rows even when executors are lost, read only the
    columns they need, and know the size of the table. ``by`` keeps each value
    of a column with few values in its own folder, so that a filter on it
    reads nothing else. The files stay until the application's scratch folder
    is removed.
    """
    path = scratch_path(df.sparkSession, name)
    if by is None:
        df.write.parquet(path)
    else:
        df.hint("rebalance", by).write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete everything this application settled; returns whether there was something to delete."""
    files, folder = file_system(spark, scratch_root(spark))
    return files.delete(folder, True)
