"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm.common import cut

MAX_ROUNDS = 100


def connected_components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, root`` for every node that has a link to another; ``root`` is its least node.

    ``links`` may hold both directions, repeats and loops; rows with a null end are
    no links. Each step is two grouped minima joined back to the links, so a hub is
    combined before it is shuffled and its join partition may be split. The rounds
    grow with the logarithm of the longest path; each is a written table.
    """
    ends = links.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    now = cut(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = _mark(now)
    for _ in range(MAX_ROUNDS):
        if seen[0] == 0:
            break
        now = cut(_small_star(_large_star(now)), "links")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components are not settled after {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of the links."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("s"),
    ).first()
    return row["n"], row["s"]


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
