"""Shared intermediate storage: tables that every executor and the driver can read.

Intermediate results are written as Parquet below ``spark.checkpoint.dir``. That
cuts lineage, survives the loss of executors and is far smaller than a row-wise
checkpoint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no folder (single-machine tests).
LOCAL_FALLBACK = "/tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """Folder that all machines share, from ``spark.checkpoint.dir``."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{LOCAL_FALLBACK}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back (lineage cut)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared storage, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialize`; call only when nothing reads it any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        delete(df.sparkSession, path)
