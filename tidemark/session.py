"""Session defaults and the folder in which jobs may keep intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there the driver and
    the executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root; nothing is ever overwritten in place."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame once, in even files, and read it back.

    Used where several jobs read the same derived rows. The result has no lineage to
    recompute, survives the loss of executors, and each later job reads only the columns it
    needs; ``partition_by`` (a fold number, say) lets jobs skip the other rows.
    """
    path = new_folder(df.sparkSession, label)
    df = df.hint("rebalance")  # files large enough to read well, enough of them for all cores
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
