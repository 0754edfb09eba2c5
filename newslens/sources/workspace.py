"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the checkpoint folder set on its context.

    There is no other: executors do not see the driver's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder


def own_folder(spark: SparkSession) -> str:
    """Where this application's tables lie."""
    return f"{shared_folder(spark).rstrip('/')}/newslens/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and go on from the table.

    Cuts the lineage at a table that outlives executors, and lets each later reader fetch
    only the columns and partitions it needs.
    """
    return written_at(df, new_path(df.sparkSession, name), partition_by)


def written_at(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``written`` at a path of ``new_path``, for tables that are deleted before the job ends."""
    df.write.partitionBy(*partition_by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select(*df.columns)


def delete(spark: SparkSession, path: str) -> None:
    """Delete one written table."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def clean_up(spark: SparkSession) -> None:
    """Delete all tables this application has written; its earlier results can no longer be read."""
    delete(spark, own_folder(spark))
