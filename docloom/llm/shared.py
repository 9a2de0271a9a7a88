"""What the operators of this subpackage share: scratch tables and Arrow helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task turns into numpy arrays at a time (one longer text is a chunk by itself).
CHUNK_BYTES = 4 << 20
#: A key of more than one row in so many is hot.
HOT = 2000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it. Only a session that is one process may go without: it gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, among those of this application."""
    return f"{shared_dir(spark)}/docloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the tables that this application wrote in the shared folder; frames that read them are void then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/docloom/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """A written frame, marked for broadcast if it has no more than so many (narrow) rows; else left to Spark's own choice of a join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_values(rows: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """Written rows with `value` of the table's row of their key (one for each key), or null.

    A key that more than one row in HOT has (there are less than HOT such keys, whatever the input) gets its value by a
    broadcast, so that no task of the shuffled join holds it; rows without a key pass by.
    """
    table = table.select(key, value)
    often = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") * HOT > rows.count())
    hot = written(often.select(key).join(table, key).select(F.col(key).alias("hot_key"), F.col(value).alias("hot_value")), "hot-keys")
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
    direct = marked.where(F.col("hot_key").isNotNull() | F.col(key).isNull()).withColumn(value, F.col("hot_value"))
    rest = marked.where(F.col("hot_key").isNull() & F.col(key).isNotNull()).join(table, key, "left")
    return rest.select(*rows.columns, value).unionByName(direct.select(*rows.columns, value))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def valid(text: Column) -> Column:
    """The text with U+FFFD in place of each byte sequence that isn't UTF-8, so that one damaged text can't fail a job."""
    return F.make_valid_utf8(text.cast("string"))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, whatever else the table has; texts are valid UTF-8."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), valid(docs[text_col]).alias("text"))


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `size` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text))).fill_null(0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def release_memory() -> None:
    """Gives back to the system what Arrow and the C library keep for later: Python workers live on beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_chunks(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str, text: str = "text") -> DataFrame:
    """`fn` over chunks of the rows, bounded by the bytes of column `text` (if ""; by Arrow's batches); it returns the columns of its result."""
    struct = T.StructType.fromDDL(schema)
    target = arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text) if text else (b for b in batches if b.num_rows):
            out = fn(chunk)
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in target], schema=target)
            chunk = out = None
        release_memory()

    return df.mapInArrow(run, struct)


def free_prefix(df: DataFrame, prefix: str = "own_") -> str:
    """A prefix that none of the frame's columns has."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    return prefix


def annotated(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, text: str = "text") -> tuple[DataFrame, str]:
    """(every row with all its columns and those that `fn` computes of its chunk, the prefix that sets the new names apart)."""
    prefix = free_prefix(df)
    added = T.StructType([T.StructField(prefix + f.name, f.dataType) for f in T.StructType.fromDDL(schema).fields])
    struct = T.StructType([*df.schema.fields, *added.fields])
    target = arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text):
            out = fn(chunk)
            new = [pa.array(out[f.name.removeprefix(prefix)], type=target.field(f.name).type) for f in added.fields]
            yield pa.RecordBatch.from_arrays([*chunk.columns, *new], schema=pa.schema([*chunk.schema, *[target.field(f.name) for f in added.fields]]))
            chunk = out = new = None
        release_memory()

    return df.mapInArrow(run, struct), prefix


def names_of(df: DataFrame) -> list[Column]:
    """The frame's columns, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_digest(text: str = "text"):
    """A digest by which equal texts meet (null counts as empty)."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
