"""Connected components of an edge table, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import shared_dir
from millrace.session import remove

MAX_ROUNDS = 200


def connected_components(edges: DataFrame, left: list | None = None) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; ``root`` is the smallest node reached.

    Alternating stars: the large star hangs the larger neighbours of a node
    under its smallest neighbour, the small star does so with the smaller ones.
    The edges of a node are only ever reduced to a minimum, so a node with very
    many edges needs no large group. Each round is written to the shared folder in
    place of the one before; the rounds grow with the logarithm of the longest path.
    ``left`` gets the session and path of the last, for a caller that is done with it.
    """
    spark = edges.sparkSession

    def stored(df: DataFrame) -> tuple[DataFrame, str]:
        path = shared_dir(spark, "stars")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    links, path = stored(_distinct(edges.select("a", "b").where("a <> b")))
    last = None
    for _ in range(MAX_ROUNDS):
        before = path
        links, path = stored(_small_star(_large_star(links)))
        remove(spark, before)
        state = links.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if state == last:
            if left is not None:
                left.append((spark, path))
            return _rooted(links)
        last = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _distinct(pairs: DataFrame) -> DataFrame:
    """``a > b`` for every pair."""
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a").join(least, "a")
    return _distinct(larger.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _distinct(least.select("a", F.col("m").alias("b")).unionByName(moved))


def _rooted(stars: DataFrame) -> DataFrame:
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
