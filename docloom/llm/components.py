"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import written


def _towards_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the component's least node.

    Steps repeat until the edges stay the same; each is written, so lost executors cost one step. Hubs are grouped with
    a partial aggregation and joined back, never gathered.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _towards_least(large)  # every v of an edge lies below its u
        small = near.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == mark:
            break
        mark = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(roots)
