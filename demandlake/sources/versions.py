"""A folder of versioned tables: a version is written whole, then published by one row.

Readers go by the newest published version. What a failed run has left of a version
is overwritten by the next try, and nobody has seen it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class VersionedTables:
    """Tables under ``path``, each in a folder per version."""

    spark: SparkSession
    path: str

    def current(self) -> int:
        """The newest published version, 0 before the first."""
        try:
            published = self.spark.read.schema("version long").parquet(f"{self.path}/published")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return published.agg(F.max("version")).first()[0] or 0

    def publish(self, version: int) -> None:
        """Make a version the one that readers see: a single row, there or not there."""
        one = self.spark.range(version, version + 1).select(F.col("id").alias("version"))
        one.coalesce(1).write.mode("append").parquet(f"{self.path}/published")

    def folder(self, table: str, version: int) -> str:
        return f"{self.path}/{table}/version={version}"

    def write(self, df: DataFrame, table: str, version: int, *partitions: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions).parquet(
            self.folder(table, version)
        )

    def read(self, table: str, version: int, schema: str | StructType) -> DataFrame:
        """A table as of a version; empty as of version 0."""
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder(table, version))

    def remove(self, *folders: str) -> None:
        """Delete folders that no published version refers to any more; one that is gone already is no error."""
        jvm = self.spark._jvm
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def exists(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def part(self, column: str, value: str) -> str:
        """The folder name of a partition."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"{column}={escape(value)}"
