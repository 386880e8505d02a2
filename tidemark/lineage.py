"""Cutting lineage: tables written to a folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    and driver and executors are one process (tests, a laptop) a temporary
    folder of this machine is made once.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    jsc = sc._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return jsc.getCheckpointDir().get().rstrip("/")


def place(spark: SparkSession, path: str):
    """Path and file system as Hadoop knows them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def table(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back; the driver's end deletes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    p, fs = place(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table made by :func:`table` once nothing reads it any more."""
    path = getattr(df, "_tidemark_path", None)
    if path:
        p, fs = place(df.sparkSession, path)
        fs.delete(p, True)
