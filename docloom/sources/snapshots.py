"""Versioned snapshots of a mutable table on immutable files: one writer, and a pointer that moves last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.sources.changelog import only_missing

POINTER = "version long, mark string, written_at timestamp"


class Snapshots:
    """A table at a path. A reader sees the last version that was written whole; a writer that fails leaves no trace."""

    def __init__(self, spark: SparkSession, path: str, schema: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.path, self.schema, self.partition_by = spark, path.rstrip("/"), schema, partition_by
        self.names = T.StructType.fromDDL(schema).names

    def versions(self) -> DataFrame:
        return self.spark.read.schema(POINTER).parquet(f"{self.path}/pointer")

    def version(self) -> int:
        none = lambda: self.spark.createDataFrame([], POINTER)
        found = only_missing(self.versions, none).agg(F.max("version")).first()[0] or 0
        if not found and not only_missing(lambda: self.spark.read.schema("value string").parquet(f"{self.path}/v=*"), none).isEmpty():
            raise ValueError(f"{self.path} has versions but no pointer to one")
        return found

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}").select(*self.names)

    def has(self, mark: str) -> bool:
        """Whether a version was written under this mark, such as a micro-batch's number."""
        return self.version() > 0 and not self.versions().where(F.col("mark") == mark).isEmpty()

    def write(self, table: DataFrame, mark: str | None = None) -> int:
        """The table as the next version."""
        version = self.version() + 1
        table.select(*self.names).write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.path}/v={version}")
        pointer = self.spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(mark).cast("string").alias("mark"), F.current_timestamp().alias("written_at"))
        pointer.coalesce(1).write.mode("append").parquet(f"{self.path}/pointer")
        return version
