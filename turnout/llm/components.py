"""Connected components of a graph given as a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.sinks import shared_dir


def _stored(df: DataFrame, at: str) -> DataFrame:
    """Written and read again, which cuts the lineage and outlives lost executors."""
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def _to_least(pairs: DataFrame, keep_own: bool) -> DataFrame:
    """Attach the neighbours of each ``u`` to the least of them and itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if keep_own:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``), the label being the least node reachable.

    Nodes without links, and links of a node to itself, have no row. The number of rounds grows
    with the logarithm of the longest path; each round moves every link a few times, and the least
    neighbour of a node is found by partial sums, so a node with very many links is no hot spot.
    """
    root, rounds = shared_dir(links.sparkSession, "components"), 0
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges, before = _stored(edges, f"{root}/0"), None
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    while (now := mark(edges)) != before and now[0]:
        before, rounds = now, rounds + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours of each node go to its least neighbour, then smaller ones do.
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _stored(large.where("u > v").distinct(), f"{root}/{rounds}-large")
        edges = _stored(_to_least(large, keep_own=True), f"{root}/{rounds}")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
