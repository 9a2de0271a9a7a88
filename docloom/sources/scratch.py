"""Intermediate tables in the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_stages(spark: SparkSession) -> None:
    """Deletes the intermediate tables that this application wrote; frames that read them are void then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(fresh_path(spark, "none").rpartition("/")[0])
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written and read again, so that what calls a service runs once and is not called again for a later step."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
