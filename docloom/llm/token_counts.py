"""Token counts through a digest cache.

The cache is a Parquet table (tokenizer, digest, n_bytes, n_tokens). A text's key is the SHA-256 digest of its
normalised content (null becomes the empty text; nothing else is changed, as any other change may alter a count) and
the digest of the tokenizer's file, so that a new tokenizer version misses. Digests go first: one pass over the texts
writes them (narrow rows), and the distinct ones that the cache lacks are found without a text. Only then are the texts
of these fetched, reduced to one per digest in each task before they are shuffled, encoded and appended. Where few are
missing (a checked number) no other text leaves its task; with none missing, texts aren't read again. Counts go back to
the rows by a join on the digest, those of hot digests by a broadcast.

Edge cases: null and empty texts have 0 bytes and 0 tokens; bytes that aren't UTF-8 count as U+FFFD; repeated rows are
kept, each with its count; null ids are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.pieces import is_whole, units
from docloom.llm.shared import documents, id_and_text, map_chunks, scratch, text_digest, with_values, written

CACHE = "tokenizer string, digest binary, n_bytes long, n_tokens long"

#: Entries of a Python worker's memo of units; beyond it the memo starts anew.
MEMO = 1_200_000
#: Missing digests up to which they are broadcast to the texts (44 bytes each).
FEW = 200_000


@functools.cache
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@functools.cache
def specials(path: str) -> list[str]:
    return [x.content for x in library(path).get_added_tokens_decoder().values()]


def version(path: str) -> str:
    """The digest of the tokenizer's file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


@functools.cache
def memo_of(path: str) -> dict[str, int]:
    """Counts of the units that this Python worker has met, for one tokenizer."""
    return {}


class Counter:
    """Counts of texts; a unit that was met before is not encoded again."""

    def __init__(self, path: str):
        self.path, self.memo = path, memo_of(path)

    def __call__(self, texts: list[str]) -> list[int]:
        encode, memo, odd = library(self.path).encode_batch_fast, self.memo, specials(self.path)
        if len(memo) > MEMO:
            memo.clear()
        parts = [None if is_whole(t, odd) else units(t) for t in texts]
        new = list(set(itertools.chain.from_iterable(p for p in parts if p)).difference(memo))
        if new:
            owner = library(self.path).encode(new, is_pretokenized=True, add_special_tokens=False).word_ids
            memo.update(zip(new, np.bincount(owner, minlength=len(new)).tolist(), strict=True))
        whole = iter(encode([t for t, p in zip(texts, parts, strict=True) if p is None], add_special_tokens=False))
        return [len(next(whole).ids) if p is None else sum(map(memo.__getitem__, p)) for p in parts]


def is_byte_level(path: str) -> bool:
    """Whether units are safe: a byte-level pre-tokenizer with its usual pattern and no normalizer."""
    import json

    spec = json.loads(library(path).to_str())
    pre = spec["pre_tokenizer"] or {}
    return not spec["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")


def encoded(misses: DataFrame, path: str) -> DataFrame:
    """misses (digest, text): the rows of the cache for them."""
    name, by_units = version(path), is_byte_level(path)
    state: dict = {}

    def count(chunk: pa.RecordBatch) -> dict:
        texts = chunk.column("text").fill_null("").to_pylist()
        if by_units:
            tokens = state.setdefault("count", Counter(path))(texts)
        else:
            tokens = [len(x.ids) for x in library(path).encode_batch_fast(texts, add_special_tokens=False)]
        return {"tokenizer": [name] * len(texts), "digest": chunk.column("digest"), "n_bytes": chunk.column("n_bytes"), "n_tokens": tokens}

    return map_chunks(misses.select("digest", F.octet_length("text").cast("long").alias("n_bytes"), "text"), count, CACHE)


def missing_texts(keyed: DataFrame, misses: DataFrame) -> DataFrame:
    """(digest, text): one text for each of the missing digests."""
    few = misses.limit(FEW + 1).count() <= FEW
    found = keyed.join(F.broadcast(misses), "digest", "left_semi") if few else keyed
    texts = found.groupBy("digest").agg(F.first("text").alias("text"))
    return texts if few else texts.join(misses, "digest", "left_semi")


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; `cache` is the path of the table, made if it is missing."""
    spark = docs.sparkSession
    keyed = id_and_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_digest().alias("digest"))
    rows = written(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    known = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version(tokenizer))
    misses = written(rows.select("digest").distinct().join(known.select("digest"), "digest", "left_anti"), "misses")
    if not misses.isEmpty():
        encoded(missing_texts(keyed.select("digest", "text"), misses), tokenizer).write.mode("append").parquet(cache)
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version(tokenizer))
    counts = stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    found = with_values(rows, counts, "digest", "n_tokens")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), scratch(spark, "token-cache"))
