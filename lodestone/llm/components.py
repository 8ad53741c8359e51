"""Connected components of an edge table, by large-star and small-star rounds.

Each round points every node at the smallest node of its neighbourhood; the
rounds end when the edges are stars (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014).  Edges stay in Spark throughout; only a count
and a checksum of each round come to the driver.  Both sides of every join
grow with the corpus, so all are sort-merge joins and nothing is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.scratch import discard, materialise


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    sym = _both(edges)
    low = sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return sym.where("v > u").join(low.hint("merge"), "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low.hint("merge"), "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b")
    return moved.unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of longs -> (node, root): every node met, root the smallest of its component."""
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        moved = materialise(_small_star(_large_star(edges)), "edges")
        after = _mark(moved)
        discard(edges)
        edges = moved
        if after == mark:
            break
        mark = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
