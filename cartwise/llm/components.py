"""Connected components of a graph of links, by alternating large-star and small-star rounds.

Every round is two grouped minima and two joins; the links are written to the shared folder after each, so
that lost executors cost at most a round. A node with very many links is split by the
adaptive skew join, and minima are combined before their shuffle. No links reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.session import materialise

MOST_ROUNDS = 50


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38, 0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Join every greater neighbour of a node to the node's smallest neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them; ``a > b`` in every link."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node that is not the smallest itself.

    ``links`` has two columns ``a`` and ``b`` of one ordered type; direction, repeated links, links of a node
    to itself and links with a null end do not matter.
    """
    own = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") != F.col("b")).alias("apart"))
    now = materialise(own.filter("apart").select("a", "b").distinct(), "links")
    state = _state(now)
    for _ in range(MOST_ROUNDS):
        if not state[0]:
            break
        now = materialise(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
