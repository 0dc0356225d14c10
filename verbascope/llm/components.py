"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.session import stable_table


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u > v): hang the larger (or smaller) neighbours of each node on its least neighbour."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("w"))
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("w")))
    least = both.groupBy("n").agg(F.least(F.min("w"), F.col("n")).alias("m"))
    linked = both.where(F.col("w") > F.col("n")) if large else both
    hung = linked.join(least, "n").select(F.col("w").alias("u"), F.col("m").alias("v"))
    if not large:
        hung = hung.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v")))
    return hung.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node with an edge; ``edges`` has longs ``u`` and ``v``.

    The component is its least node. Each step is written to the shared folder; the rounds grow with the logarithm
    of the longest path. Self-links and repeated links don't matter; without links the result is empty.
    """
    now = stable_table(
        edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = None
    while True:
        print_of = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == tuple(print_of) or not print_of[0]:
            break
        seen = tuple(print_of)
        now = stable_table(_stars(_stars(now, True), False))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
