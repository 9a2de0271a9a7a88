"""Service logs as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A line's time, level and message; other lines belong to the entry above them.
LINE = r"^(\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d(?:[.,]\d+)?)\S*\s+(TRACE|DEBUG|INFO|WARN|ERROR)\b\s*(.*)$"


def _marked(lines: DataFrame, *parts: str) -> DataFrame:
    """Lines (..., at, value) with the entry of their part that they belong to (null before the first) and what they add to it."""
    group = lambda k: F.regexp_extract("value", LINE, k)
    by = Window.partitionBy(*parts).orderBy("at")
    head = F.col("value").rlike(LINE)
    rows = lines.withColumn("head", F.when(head, F.col("at"))).withColumn("entry", F.last("head", ignorenulls=True).over(by))
    ts = F.try_to_timestamp(F.replace(F.replace(group(1), F.lit("T"), F.lit(" ")), F.lit(","), F.lit(".")))
    begins = F.col("head").isNotNull()
    return rows.select(*parts, "entry", "at", F.when(begins, ts).alias("ts"), F.when(begins, group(2)).alias("level"), F.when(begins, group(3)).otherwise(F.col("value")).alias("own"))


def _gathered(rows: DataFrame, *parts: str) -> DataFrame:
    found = rows.groupBy(*parts, "entry").agg(F.max("ts").alias("ts"), F.max("level").alias("level"), F.array_sort(F.collect_list(F.struct("at", "own"))).alias("lines"))
    return found.withColumn("lines", F.transform("lines", lambda x: x["own"]))


def entries(lines: DataFrame) -> DataFrame:
    """(file, ts, level, message) of lines (file, at, value), `at` ordering a file's lines: a line that begins no entry belongs to the message above it.

    Lines before a file's first entry belong to none. `at` can be sparse, such as a byte offset or a row's number.
    """
    found = _gathered(_marked(lines, "file").where("entry is not null"), "file")
    return found.select("file", "ts", "level", F.array_join("lines", "\n").alias("message"))


def split_entries(lines: DataFrame) -> DataFrame:
    """(file, ts, level, message) of lines (file, block, at, value) of files that are read in blocks, the same as of whole files.

    A block's entries are put together by itself; its leading lines go to the last entry of the nearest block before it
    that has one, over as many blocks as a message is long. No window holds more than a block's lines or a file's blocks.
    """
    pieces = _gathered(_marked(lines, "file", "block"), "file", "block")
    ends = pieces.groupBy("file", "block").agg(F.max("entry").alias("last"))
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    target = F.last(F.when(F.col("last").isNotNull(), F.struct("block", "last")), ignorenulls=True).over(above)
    ends = ends.withColumn("to", target).where("to is not null").select("file", "block", F.col("to.block").alias("to_block"), F.col("to.last").alias("to_entry"))
    handed = pieces.where("entry is null").join(ends, ["file", "block"]).groupBy("file", "to_block", "to_entry").agg(F.array_sort(F.collect_list(F.struct("block", "lines"))).alias("more"))
    handed = handed.select("file", F.col("to_block").alias("block"), F.col("to_entry").alias("entry"), F.flatten(F.transform("more", lambda x: x["lines"])).alias("more"))
    found = pieces.where("entry is not null").join(handed, ["file", "block", "entry"], "left")
    whole = F.when(F.col("more").isNull(), F.col("lines")).otherwise(F.concat("lines", "more"))
    return found.select("file", "ts", "level", F.array_join(whole, "\n").alias("message"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(file, ts, level, message) of every entry of the log files, messages of several lines included.

    Spark reads the files in blocks (`spark.sql.files.maxPartitionBytes`), a line in the block where it begins, so that a
    large file is the work of many tasks. Within a block, rows are numbered in the order in which they are read.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    return split_entries(rows.where("value <> ''"))


def since_restart(log: DataFrame, marker: str, group: str = "file") -> DataFrame:
    """Entries from the last restart marker of each log on; all of them where there is none."""
    last = log.where(F.col("message").contains(marker)).groupBy(group).agg(F.max("ts").alias("restarted"))
    return log.join(last, group, "left").where(F.col("restarted").isNull() | (F.col("ts") >= F.col("restarted"))).drop("restarted")


def matching(log: DataFrame, pattern: str, last: int | None = None) -> DataFrame:
    """Entries that match, all or the last ones in order of time."""
    found = log.where(F.col("message").rlike(pattern))
    return found if last is None else found.orderBy(F.desc("ts"), F.desc("message")).limit(last).orderBy("ts", "message")


def token_usage(log: DataFrame) -> DataFrame:
    """(ts, prompt, completion) of entries that state `tokens=prompt/completion`, most completion tokens first."""
    pair = r"(\d+)/(\d+)"
    found = log.where(F.col("message").rlike(pair))
    number = lambda k: F.regexp_extract("message", pair, k).cast("long")
    return found.select("ts", number(1).alias("prompt"), number(2).alias("completion")).orderBy(F.desc("completion"), F.desc("prompt"))


def minute_deltas(counts: DataFrame, value: str = "n", key: str | None = None) -> DataFrame:
    """Minute-over-minute changes of cumulative counts (minute, n), for each key apart."""
    by = Window.partitionBy(*([key] if key else [])).orderBy("minute")
    return counts.withColumn("delta", F.col(value) - F.lag(value).over(by))
