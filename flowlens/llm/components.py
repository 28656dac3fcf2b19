"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round hangs a node's neighbours on the least of them with one aggregate and one join; the edge
table is written to the shared folder in between, so a lost executor costs a round at most. Only a
count and a checksum come to the driver. Trees of stars result after a number of rounds that grows with
the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    hung = down.join(least, "a").where("b != root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return hung.union(least.select("a", F.col("root").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root of every node that has an edge; root is the least node that edges reach. Loops and nulls are left out."""
    edges = written(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a != b").distinct(), "edges"
    )
    state = None
    for _ in range(MAX_ROUNDS):
        edges = written(_small_star(_large_star(edges)), "star")
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
