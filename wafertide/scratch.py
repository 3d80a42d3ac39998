"""Intermediate tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Only a local session may go without: it gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="wafertide-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that is deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/wafertide/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several plans read and read it back, which cuts the lineage for good."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
