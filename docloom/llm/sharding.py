"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard has virtual nodes on a ring of 2^62 positions; a row goes to the next node clockwise, and when that node's
shard is full it continues clockwise to the first shard that has room. Rows count in ring order. With a load factor of
1 the quotas add up to the rows exactly, so shards differ by at most one row; a larger factor moves fewer rows.

How it runs: rows of one id, size and checksum are told apart by nothing, so they are counted first and stand together on
the ring, in the order (position, id, checksum, size) that depends on the rows alone: the same rows get the same shards in
whatever layout they come. The ring is cut at the nodes and into equal cells, a fixed number of segments. Spark counts the
rows of each segment; the walk along the ring, over segments instead of rows, gives each segment a few ranges (rank from,
rank to, shard, first slot). Distinct rows are ranked within their segment and take their parts of the ranges; parts with
many copies are dealt out over all tasks before they become rows again. Positions are hashes of distinct rows, so segments
are even. The tables that leave for the driver or are broadcast hold at most CELLS + shards * NODES + shards rows, whatever
the input.

Edge cases: null texts have size 8; null ids, repeated ids and repeated rows are rows like others; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.shared import documents, id_and_text, written

RING = 1 << 62
CELLS = 1 << 14
NODES = 64
#: Copies of a row that a task makes at once.
COPIES = 10_000


def nodes(shards: int, per_shard: int = NODES) -> list[tuple[int, int]]:
    """(position, shard) of the virtual nodes, in ring order. A shard's nodes don't depend on the number of shards."""
    return sorted((int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big") % RING, s) for s in range(shards) for v in range(per_shard))


def segments(shards: int) -> list[tuple[int, int, int]]:
    """(first position, cell, node number) of each piece of the ring, in ring order."""
    ring = [p for p, _ in nodes(shards)]
    cuts = sorted({*ring, *(c * (RING // CELLS) for c in range(CELLS))})
    return [(p, p // (RING // CELLS), bisect.bisect_left(ring, p + 1) % len(ring)) for p in cuts]


def walk(counts: list[tuple[int, int]], ring: list[int], quotas: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(segment, from, to, shard, slot) for segments (number, rows, in ring order) of `counts` as (node, rows)."""
    room, out = list(quotas), []
    for number, (node, rows) in enumerate(counts):
        done, at = 0, node
        while done < rows:
            shard = ring[at % len(ring)]
            take = min(rows - done, room[shard])
            if take:
                out.append((number, done, done + take, shard, quotas[shard] - room[shard]))
                room[shard] -= take
                done += take
            at += 1
    return out


def copied(parts: DataFrame, copies: int = COPIES) -> DataFrame:
    """A row for each slot of parts (..., slot, n): n of them from the slot on. Parts of many copies are cut up and dealt out first."""
    names = [c for c in parts.columns if c not in ("slot", "n")]
    slots = F.explode(F.sequence("slot", F.col("slot") + F.col("n") - 1)).alias("slot")
    few = parts.where(F.col("n") <= copies).select(*names, slots)
    cut = parts.where(F.col("n") > copies).select(*names, "slot", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(copies).cast("long"))).alias("done"))
    cut = cut.select(*names, (F.col("slot") + F.col("done")).alias("slot"), F.least(F.lit(copies), F.col("n") - F.col("done")).alias("n"))
    many = cut.repartition(*[F.col(c) for c in (*names, "slot")]).select(*names, slots)
    return few.unionByName(many)


def shard(docs: DataFrame, shards: int = 24, load_factor: float = 1.0, id_col: str = "doc_id", text_col: str = "text", copies: int = COPIES) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = id_and_text(docs, id_col, text_col).select("doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    rows = rows.withColumn("at", F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 2))
    parts = segments(shards)
    table = [(n, cell, a, b) for n, ((a, cell, _), (b, _, _)) in enumerate(itertools.pairwise([*parts, (RING, 0, 0)]))]
    cut = spark.createDataFrame(table, "segment int, cell long, low long, high long")
    placed = rows.withColumn("cell", F.shiftright("at", (RING // CELLS).bit_length() - 1))
    placed = written(placed.join(F.broadcast(cut), "cell").where("at >= low and at < high").drop("cell", "low", "high"), "ring")
    counts = {r.segment: r.n for r in placed.groupBy("segment").agg(F.sum("n").alias("n")).collect()}
    total = sum(counts.values())
    least, more = divmod(total, shards)
    exact = [least + (s < more) for s in range(shards)]
    quotas = exact if load_factor <= 1 else [max(q, int(load_factor * total / shards) + 1) for q in exact]
    ranges = walk([(node, counts.get(n, 0)) for n, (_, _, node) in enumerate(parts)], [s for _, s in nodes(shards)], quotas)
    ranges = spark.createDataFrame(ranges, "segment int, low long, high long, shard int, first long")
    before = Window.partitionBy("segment").orderBy("at", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("from", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("to", F.col("from") + F.col("n"))
    taken = ranked.join(F.broadcast(ranges), "segment").where("from < high and to > low")
    begin = F.greatest("from", "low")
    return copied(taken.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + begin - F.col("low")).alias("slot"), (F.least("to", "high") - begin).alias("n")), copies)


def op5_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(documents(spark, sf_dir), shards=24, load_factor=1.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
