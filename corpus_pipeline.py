"""A corpus pipeline: quality classifier, quality rules, near duplicates, repeated passages, packing.

Every stage is a function of (spark, docs, sf_dir) over all that the stage before it kept; its result is written in the
shared folder and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.classifier import accepted
from docloom.llm.jaccard import one_of_each
from docloom.llm.packing import pack
from docloom.llm.rules import kept_rows
from docloom.llm.shared import documents, written
from docloom.llm.substrings import without_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, trained on the labels, does not reject."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the limits of their language and source."""
    return kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of documents that links of five-word shingles at 0.8 connect."""
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier; one that nothing is left of goes."""
    return without_repeats(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens in sequences of 4096."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("packing", packing),
]

#: SQL expresses neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
