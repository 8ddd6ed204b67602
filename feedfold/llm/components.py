"""Connected components of a table of links, by stars that grow and shrink.

Each round turns the neighbours of every node towards the smallest one it
knows, first the larger neighbours, then the smaller ones, until every
component is one star around its smallest node. The smallest neighbour is an
aggregate that is joined back, so no task holds the links of a node, and each
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import landed


def large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").where("u != v").distinct()


def small_star(links: DataFrame) -> DataFrame:
    down = links.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").where("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    turned = down.join(least, "u").selectExpr("v AS u", "m AS v").where("u != v")
    return turned.union(least.selectExpr("u", "m AS v")).distinct()


def mark(links: DataFrame) -> tuple:
    """Tells sets of links apart: sums of bounded hashes, which ids of any size cannot overflow."""
    hashed = F.xxhash64("u", "v")
    row = links.agg(
        F.count("*").alias("n"), F.sum(hashed % 1_000_003).alias("h"), F.sum(F.shiftright(hashed, 20) % 1_000_000_007).alias("s")
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(u, v) for each node that is not the smallest of its component: the node and the smallest one."""
    stars = landed(small_star(links), "links")
    before = mark(stars)
    while True:
        stars = landed(small_star(large_star(stars)), "links")
        now = mark(stars)
        if now == before:
            return stars
        before = now
