"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Stored


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges``: the smallest node that it can reach.

    Alternates large stars (a node's larger neighbours move to its smallest) and small stars
    (its smaller ones do), which ends in one star per component after few rounds.  A round
    never makes more edges than it was given, whatever the degree of a node, its aggregations are
    combined in the map tasks, and each round's edges are a stored table.
    """
    def distinct_edges(df: DataFrame) -> DataFrame:
        return df.where(F.col("a") != F.col("b")).distinct()

    def both_ways(df: DataFrame) -> DataFrame:
        return df.select("a", "b").unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(df: DataFrame, large: bool) -> DataFrame:
        pairs = both_ways(df) if large else df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = pairs.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("low"))
        moved = pairs.join(lowest, F.col("a") == F.col("node"))
        if large:
            return distinct_edges(moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")))
        own = lowest.select(F.col("node").alias("a"), F.col("low").alias("b"))
        return distinct_edges(moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(own))

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = Stored(distinct_edges(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    seen = None
    for _ in range(most_rounds):
        now = digest(current.df)
        if now == seen or not now[0]:
            break
        seen = now
        following = Stored(star(star(current.df, large=True), large=False), "edges")
        current.drop()
        current = following
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return current.df.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.df.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
