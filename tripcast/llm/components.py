"""Connected components of a graph given as a table of links, by alternating stars.

Large star: every node's larger neighbours attach to the smallest node it knows;
small star: the node and its smaller neighbours do. Each round is two aggregations
and two joins on shuffled tables, written to the shared folder; nothing is gathered
on the driver but one count. The rounds end when links are stars, each around the
smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm import rounds as R


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a"))
    least = down.groupBy("b").agg(F.min("a").alias("m"))
    moved = down.join(least, "b").select(F.col("m").alias("u"), F.col("a").alias("v")).where("u < v")
    return moved.union(least.select(F.col("m"), F.col("b"))).toDF("a", "b").where("a < b")


def _stars(links: DataFrame) -> bool:
    """Whether each larger end of a link occurs in that link only."""
    ends = links.select(F.col("b").alias("node"), F.lit(1).alias("larger")).unionByName(
        links.select(F.col("a").alias("node"), F.lit(0).alias("larger")))
    seen = ends.groupBy("node").agg(F.sum("larger").alias("larger"), F.count("*").alias("all"))
    return seen.where("larger > 0 and all > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """links(a long, b long) to members(node long, component_id long): each node with the smallest one reachable.

    Loops, doubled links and either direction are fine; nulls are left out. Nodes
    without a link to another one are not listed.
    """
    spark = links.sparkSession
    now = R.written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b"), "links")
    old = []
    while not _stars(now):
        old.append(now)
        now = R.written(_small_star(_large_star(now)).distinct(), "links")
    R.dropped(spark, *old)
    return now.select(F.col("b").alias("node"), F.col("a").alias("component_id")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component_id")).distinct())
