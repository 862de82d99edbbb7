"""Connected components by alternating large-star and small-star rounds.

Every round is a grouped minimum and one join on the node, so a node with very many links
is combined before its shuffle and split by the adaptive skew join. Links are written to the
shared folder after each round; nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.session import materialize

MAX_ROUNDS = 100


def _minima(links: DataFrame) -> DataFrame:
    """Each node ``u`` with the least of itself and its neighbours."""
    return (links.groupBy("u").agg(F.min("v").alias("m"))
            .select("u", F.least("u", "m").alias("m")))


def large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to its least neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them. Links have u > v."""
    least = _minima(links)
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node in ``links`` (two bigint columns ``u``, ``v``).

    ``component`` is the least node reachable. Loops, repeated links, and links with a null
    end are ignored; no links give an empty table.
    """
    now = materialize(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        # Both ends enter the sum through a hash, so any change of any link changes it.
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = tuple(state)
        now = materialize(small_star(large_star(now)), "links")
    raise RuntimeError(f"Components did not settle in {MAX_ROUNDS} rounds.")
