"""The document catalog: which files become tasks, their headers, and claims without a source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import UNWANTED_NAMES, wanted_name

SCHEMAS = {
    "link_cards": "card_id string",
    "card_main_info": "instance_id string, uploaded int, made_at timestamp",
    "doc_sys": "instance_id string, Kind string",
    "doc_files": "instance_id string, version_id string",
    "v_files": "instance_id string, file_id string",
    "files": "file_id string, file_name string, binary_id string",
    "binaries": "id string, data binary",
}


def read_catalog(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The catalog's tables from Parquet, by their declared schemas."""
    return {name: spark.read.schema(ddl).parquet(f"{path}/{name}.parquet") for name, ddl in SCHEMAS.items()}


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, low: str, high: str, parts: int, **options: str) -> DataFrame:
    """A catalog table over JDBC, read in parallel by ranges of a column."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=str(parts), **options).load()


def ingest_candidates(catalog: dict[str, DataFrame], queue: DataFrame, kind: str, now: Column, lookback_days: int = 4, unwanted: tuple[str, ...] = UNWANTED_NAMES, whole_history: bool = True) -> DataFrame:
    """(file_id, file_name) of files not yet queued: five joins along the cards, filters first, an anti join last.

    The look-back keeps the time of day. With `whole_history` a file that was ever queued is out, else only one queued
    within the look-back. A file that two cards name comes once.
    """
    since = now - F.make_dt_interval(days=F.lit(lookback_days))
    cards = catalog["card_main_info"].where((F.col("uploaded") == 0) & (F.col("made_at") >= since)).select(F.col("instance_id").alias("card"))
    kinds = catalog["doc_sys"].where(F.lower("Kind") == kind.lower()).select(F.col("instance_id").alias("card"))
    versions = catalog["doc_files"].select(F.col("instance_id").alias("card"), F.col("version_id").alias("version"))
    files = catalog["files"].where(wanted_name(F.col("file_name"), unwanted)).select(F.col("file_id").alias("file_id"), F.col("file_name").alias("file_name"))
    found = (
        catalog["link_cards"].select(F.col("card_id").alias("card"))
        .join(cards, "card").join(kinds, "card").join(versions, "card")
        .join(catalog["v_files"].select(F.col("instance_id").alias("version"), F.col("file_id").alias("file_id")), "version")
        .join(files, "file_id")
    )
    queued = queue if whole_history else queue.where(F.col("created_at") >= since)
    return found.groupBy("file_id").agg(F.min("file_name").alias("file_name")).join(queued.select("file_id").distinct(), "file_id", "left_anti")


def changed_cards(catalog: dict[str, DataFrame], changes: dict[str, DataFrame]) -> DataFrame:
    """(card) of the cards that new rows of any of the catalog's tables can make a candidate's: those they name, and those that their versions and files lead to."""
    files = changes["files"].select(F.col("file_id").alias("file"))
    versions = changes["v_files"].select(F.col("instance_id").alias("version")).unionByName(
        catalog["v_files"].select(F.col("instance_id").alias("version"), F.col("file_id").alias("file")).join(files.distinct(), "file", "left_semi").select("version")
    )
    owners = catalog["doc_files"].select(F.col("instance_id").alias("card"), F.col("version_id").alias("version")).join(versions.distinct(), "version", "left_semi").select("card")
    named = [changes["link_cards"].select(F.col("card_id").alias("card"))] + [changes[t].select(F.col("instance_id").alias("card")) for t in ("card_main_info", "doc_sys", "doc_files")]
    return reduce(DataFrame.unionByName, named, owners).where("card is not null").distinct()


def candidates_of_changes(catalog: dict[str, DataFrame], changes: dict[str, DataFrame], queue: DataFrame, kind: str, now: Column, lookback_days: int = 4, unwanted: tuple[str, ...] = UNWANTED_NAMES) -> DataFrame:
    """The candidates that the catalog has with the new rows `changes` (which are in it) and hadn't without them, (file_id, file_name).

    Only cards that the new rows touch are joined: what the look-back and the kind leave of them is all that can be new,
    as a card without a new row was a candidate's before or isn't one now. The tables are reduced by semi joins with those
    cards, which Spark broadcasts while they are few.
    """
    cards = changed_cards(catalog, changes)
    near = {"link_cards": "card_id", "card_main_info": "instance_id", "doc_sys": "instance_id", "doc_files": "instance_id"}
    part = {name: catalog[name].join(cards.select(F.col("card").alias(key)), key, "left_semi") for name, key in near.items()}
    return ingest_candidates(catalog | part, queue, kind, now, lookback_days, unwanted)


def headers(claims: DataFrame, files: DataFrame, binaries: DataFrame) -> DataFrame:
    """(id, claim_token, file_id, file_name, size_bytes) of claims with a source; only the payload's length is kept.

    A table that has `size_bytes` already is read without its payloads.
    """
    size = F.col("size_bytes") if "size_bytes" in binaries.columns else F.octet_length("data")
    sized = binaries.select(F.col("id").alias("binary_id"), F.coalesce(size, F.lit(0)).cast("long").alias("size_bytes"))
    named = claims.join(files.select(F.col("file_id").alias("file_id"), "binary_id"), "file_id")
    return named.join(sized, "binary_id").select("id", "claim_token", "file_id", "file_name", "size_bytes")


def missing_sources(claims: DataFrame, found: DataFrame) -> DataFrame:
    """Claims without a header."""
    return claims.join(found.select("id"), "id", "left_anti")


def payloads(claims: DataFrame, files: DataFrame, binaries: DataFrame) -> DataFrame:
    """(id, data): the claimed files' bytes."""
    named = claims.join(files.select(F.col("file_id").alias("file_id"), "binary_id"), "file_id")
    return named.join(binaries.select(F.col("id").alias("binary_id"), F.col("data").alias("data")), "binary_id").select("id", "data")
