"""Connected components of an edge table, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of edges (a, b), longs: label is the smallest node reachable.

    A large-star step hangs a node's larger neighbours under its smallest one, a small-star step its smaller ones; both
    keep the components, and stars to the smallest node are their only fixed point, reached in about log rounds. A
    node's neighbours are never gathered: minima are combined map-side and joined back, and a hot node's rows can be
    split by the skew join. Each round is written to the shared folder. Self loops and repeated edges are no matter."""
    now = written(edges.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    seen = None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("v").alias("node"), F.col("u").alias("label")).union(now.select("u", "u").distinct())
        seen = mark
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select("v", "u"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("m").alias("u"), F.col("y").alias("v")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v")).union(small.select("m", "v")).distinct()
        now = written(small)
