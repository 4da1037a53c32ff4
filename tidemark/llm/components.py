"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded_broadcast, discard, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has two long columns, taken as undirected; loops and repeats are
    dropped. Returns (node, root), roots included. Alternating large-star and
    small-star steps: every step is a grouped minimum (combined on the map
    side) and one join, and the edge table only shrinks towards stars. The
    minima are broadcast while the counted edges bound them, and are written
    and joined by shuffle beyond that, where adaptive execution splits hubs.
    """
    a, b = edges.columns[:2]
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = materialize(pairs.distinct(), "edges")
    state = _state(current)
    while state[0]:
        small_enough = 2 * state[0] <= broadcast_rows
        star = _small_star(_large_star(current, small_enough, broadcast_rows), small_enough, broadcast_rows)
        following = materialize(star, "edges")
        after = _state(following)
        discard(current)
        current = following
        if after == state:
            break
        state = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _minima(df: DataFrame, small: bool, bound: int) -> DataFrame:
    least = df.groupBy("u").agg(F.min("v").alias("m"))
    return bounded_broadcast(least, 0, bound) if small else materialize(least, "minima")


def _large_star(edges: DataFrame, small: bool, bound: int) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minima(both, small, bound).withColumn("m", F.least("u", "m"))
    found = both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return found if small else materialize(found, "large")


def _small_star(edges: DataFrame, small: bool, bound: int) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them."""
    least = _minima(edges, small, bound)
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
