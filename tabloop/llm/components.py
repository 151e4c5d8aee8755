"""Connected components of a table of links, by star contraction.

Each round points every node to the smallest node among its neighbours, first from larger to smaller neighbours
and then back; rounds repeat until the links are stars. Rounds are written tables, so a lost executor repeats one
round at most. No list of neighbours is gathered: only minima, and rows keyed by a node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.storage import settle

ROUNDS = 60  # contraction halves the work; a graph that needs more is an error, never a wrong answer


def _stars(links: DataFrame) -> DataFrame:
    """Large star then small star of (a, b) links with a > b."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where("b > a and b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.distinct()
    floor = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(floor, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                          F.col("m").alias("b"))
    return small.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node in `links` (a, b: integers); the root is the smallest node reachable.

    Null ends and links of a node to itself are ignored; repeated links count once.
    """
    greater, lesser = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = settle(links.where("a is not null and b is not null and a <> b").select(greater, lesser).distinct(), "links")
    before = None
    for _ in range(ROUNDS):
        links = settle(_stars(links), "links")
        mark = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("decimal(20,0)")).alias("h"),
            F.count_distinct("b").alias("r"),
        ).first()
        if mark == before:
            roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        before = mark
    raise RuntimeError("the links did not contract to stars")
