"""Shared scratch space for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder all executors share; the session's own setting wins over a folder in the warehouse.

    The fallback is for sessions that set nothing, as in tests. Executors on other machines cannot see a
    local warehouse, so a session on a cluster must name a shared folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not spark.sparkContext.master.startswith("local[") and warehouse.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = f"{warehouse}/_scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for one intermediate table."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to shared storage and read it back.

    Cuts lineage like a checkpoint, survives lost executors, and gives the planner real sizes.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete intermediate tables that `materialize` returned, once nothing reads them any more."""
    for df in frames:
        delete_path(df.sparkSession, df._scratch_path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
