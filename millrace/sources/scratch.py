"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new path in the folder of spark.checkpoint.dir; in local mode, where that is unset, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base}/rows-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written once and read again: what is random or costly in it happens once, and a lost executor costs no rework."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
