"""Connected components of a link table by alternating star contraction.

Each round runs a large-star step (every node hands its larger neighbours to
its smallest one) and a small-star step (the same for its smaller neighbours)
as joins and minimum aggregations; the links are checkpointed to the shared
folder after each round. The rounds end when the links are stars, after about
log(longest path) rounds; only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


ROWS_PER_TASK = 500_000


def _state(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(links.agg(F.count("*"), total).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots; a root is
    the smallest node of its component. Loops, repeats and either order are
    allowed; links with a null end are left out."""
    now = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    was, state = None, _state(now)
    while state != was:
        # as many tasks as the links need: a round has several exchanges
        now = now.coalesce(1 + state[0] // ROWS_PER_TASK)
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.union(root.select("a", F.col("m").alias("b"))).distinct())
        was, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
