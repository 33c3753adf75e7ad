"""Connected components of a graph given as edges, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from eventide.storage import materialize


def connected_components(
    edges: DataFrame, write: Callable[[DataFrame, str], DataFrame] = materialize
) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    `write` puts a table into shared storage and reads it back. `edges` has columns a and b of one orderable type. NULL ends and loops are ignored, direction and
    repetition do not matter. Without edges the result is empty.

    Each round hangs the larger neighbours of every node on its smallest neighbour, then its smaller ones
    (large-star and small-star), until nothing changes; the rounds grow with the logarithm of the
    longest path. Minima are aggregated before the shuffle and written down, so that the join with them has a
    plain shuffle on either side, which Spark splits where one node has very many edges.
    """
    a, b = F.col("a"), F.col("b")
    own = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    own = write(own, "component-edges")
    before = _state(own)
    while before[0]:
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        low = write(low.select("u", F.least("u", "low").alias("low")), "component-low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = write(large.distinct(), "component-large")
        low = write(large.groupBy("u").agg(F.min("v").alias("low")), "component-low")
        small = large.join(low, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(low.select("u", F.col("low").alias("v")))
        own = write(small.distinct(), "component-small")
        after = _state(own)
        if after == before:
            break
        before = after
    roots = own.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return own.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and practically never for others."""
    mixed = F.xxhash64("u", "v")
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.shiftright(mixed, 16)),
            F.sum(F.shiftright(F.xxhash64("v", "u", F.lit(1)), 16)),
        ).first()
    )
