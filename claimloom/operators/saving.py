"""Cutting the lineage: tables written to the shared folder and read back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where none is set, a local one is made and set if all runs on one
    machine; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="claimloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def _place(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """A new place in the shared folder, for files that are written and read again; it goes when the driver ends."""
    path = f"{shared_folder(spark)}/claimloom-{tag}-{uuid.uuid4().hex}"
    system, at = _place(spark, path)
    system.deleteOnExit(at)
    return path


def saved(df: DataFrame) -> DataFrame:
    """The rows as Parquet files in the shared folder: they outlive lost executors, and who reads them reads the columns
    it needs. They go by ``forget``, or when the driver ends."""
    spark = df.sparkSession
    path = scratch_folder(spark, "saved")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete the files of ``saved`` tables that nothing still to be computed reads."""
    for t in tables:
        system, at = _place(t.sparkSession, t._saved_at)
        system.delete(at, True)
