"""A stored table that only grows, by deltas that are published whole.

A delta is a Parquet folder. It counts once its writer's success mark is there, which is put last and in one
step, so readers see all of a run or nothing, and an interrupted run leaves nothing that counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from newslens.sources.workspace import delete


class Deltas:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def paths(self) -> list[str]:
        """Published deltas."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path
        folder = path(self.path)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        found = [s.getPath() for s in files.listStatus(folder) if s.isDirectory()]
        return sorted(p.toString() for p in found if files.exists(path(p, "_SUCCESS")))

    def read(self) -> DataFrame:
        found = self.paths()
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*found)

    def add(self, rows: DataFrame) -> int:
        """Publish the rows; how many there were. None leave no delta."""
        delta = f"{self.path}/delta-{uuid.uuid4().hex}"
        rows.write.parquet(delta)
        added = self.spark.read.schema(self.schema).parquet(delta).count()
        if not added:
            delete(self.spark, delta)
        return added
