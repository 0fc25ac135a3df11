"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.session import pin


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node of its component.

    Large-star and small-star steps in turn: each node hangs its larger neighbours, then its
    smaller ones, below the least node it knows, until nothing moves; the number of rounds
    grows with the logarithm of the longest path. Minima are combined before the shuffle,
    neighbours are joined back and never gathered, so a node with many of them is no
    single task's work. Each round is a written table, so a lost executor costs one round.
    """

    def least(pairs: DataFrame, same_side: bool) -> DataFrame:
        """For each node u of ``pairs`` (u, v) the least of u and its neighbours, joined to each pair."""
        roots = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        joined = pairs.join(roots, "u")
        if same_side:  # smaller neighbours and u itself go below m
            return joined.select(F.col("v").alias("x"), "m").union(roots.select(F.col("u").alias("x"), "m"))
        return joined.filter("v > u").select(F.col("v").alias("x"), "m")  # larger neighbours go below m

    least_first = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    rows = edges.count()
    current = pin(least_first.distinct(), rows=rows)
    mark = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = least(both, False).filter("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        small = least(large, True).filter("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        current = pin(small, rows=rows)
        now = current.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if (now["n"], now["h"]) == mark:
            break
        mark = (now["n"], now["h"])
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
