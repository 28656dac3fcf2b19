"""Hierarchies and graphs as node and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.reshape import node_set


def hierarchy_edges(managers: DataFrame, senior: str | None = None) -> DataFrame:
    """Senior → junior (distinct) and junior → lead (one edge per assignment row)."""
    m = managers.filter(F.col("snr_sm_id") == senior) if senior is not None else managers
    upper = m.select(F.col("snr_sm_id").alias("src"), F.col("jnr_sm_id").cast("string").alias("dst")).distinct().withColumn("level", F.lit(1))
    lower = m.select(F.col("jnr_sm_id").alias("src"), F.col("lead_id").cast("string").alias("dst")).withColumn("level", F.lit(2))
    return upper.unionByName(lower)


def hierarchy_nodes(managers: DataFrame, senior: str | None = None) -> DataFrame:
    """H2: node table with kind senior / junior / lead."""
    m = managers.filter(F.col("snr_sm_id") == senior) if senior is not None else managers
    s = m.select(F.col("snr_sm_id").alias("node"), F.lit("senior").alias("kind"))
    j = m.select(F.col("jnr_sm_id").alias("node"), F.lit("junior").alias("kind"))
    ld = m.select(F.col("lead_id").cast("string").alias("node"), F.lit("lead").alias("kind"))
    return s.unionByName(j).unionByName(ld).distinct()


def edge_stats(edges: DataFrame) -> DataFrame:
    """Number of edges and of distinct nodes."""
    ne = edges.agg(F.count(F.lit(1)).alias("n_edges"))
    nn = node_set(edges).agg(F.count(F.lit(1)).alias("n_nodes"))
    return ne.join(nn, how="cross")  # two one-row aggregates


def interaction_network(managers: DataFrame, interactions: DataFrame) -> DataFrame:
    """(junior, lead) edges weighted by the number of interactions (duplicates kept by the join).

    The junior side is pre-aggregated per lead before the join so that a lead with many
    interactions costs one row per junior, not one per interaction pair.
    """
    per_lead = interactions.groupBy("lead_id").agg(F.count(F.lit(1)).alias("n_interactions"))
    assign = managers.groupBy("jnr_sm_id", "lead_id").agg(F.count(F.lit(1)).alias("n_assign"))
    j = assign.join(per_lead, "lead_id", "inner")
    return j.select("jnr_sm_id", "lead_id", (F.col("n_assign") * F.col("n_interactions")).alias("n_interactions"))
