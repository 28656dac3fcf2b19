"""Sinks (S7, S10).

S10 turns node and edge DataFrames into DOT text lines on the executors and writes them as a
text dataset; layout and rendering (``dot``) are single-machine tools and are not built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line."""
    df.write.mode(mode).option("header", True).csv(path)


def _q(c: Column) -> Column:
    text = F.replace(F.replace(c.cast("string"), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    return F.concat(F.lit('"'), text, F.lit('"'))


def dot_lines(name: str, nodes: DataFrame, edges: DataFrame, directed: bool = True, clusters: DataFrame | None = None) -> DataFrame:
    """DOT text as (seq, key, line) rows.

    nodes: (id[, label, shape, cluster]) ; edges: (src, dst[, label]) ; clusters: (cluster, label). ``seq`` orders the
    header, nodes, edges and footer; ``key`` orders lines inside a section. With ``clusters``, nodes of a cluster stand in
    a subgraph of that name: its key comes first in theirs, its opening lines before them and its end after them. A node
    whose cluster is NULL stands before all subgraphs.
    """
    arrow = " -> " if directed else " -- "
    spark = nodes.sparkSession
    head = spark.createDataFrame([(0, "", f'{"digraph" if directed else "graph"} "{name}" {{')], "seq int, key string, line string")
    tail = spark.createDataFrame([(3, "", "}")], "seq int, key string, line string")
    nlabel = F.col("label") if "label" in nodes.columns else F.col("id")
    shape = F.concat(F.lit(", shape="), _q(F.col("shape"))) if "shape" in nodes.columns else F.lit("")
    key = F.col("id").cast("string")
    if clusters is not None:
        key = F.concat_ws("\u0001", F.coalesce("cluster", F.lit("")), F.lit("1"), key)
    n = nodes.select(
        F.lit(1).alias("seq"), key.alias("key"),
        F.concat(F.lit("  "), _q(F.col("id")), F.lit(" [label="), _q(nlabel), F.coalesce(shape, F.lit("")), F.lit("];")).alias("line"),
    )
    if clusters is not None:
        opening = F.concat(F.lit("  subgraph "), _q(F.concat(F.lit("cluster_"), F.col("cluster"))), F.lit(" { label="), _q(F.col("label")), F.lit(";"))
        for place, line in (("0", opening), ("2", F.lit("  }"))):
            n = n.unionByName(clusters.select(F.lit(1).alias("seq"), F.concat_ws("\u0001", "cluster", F.lit(place)).alias("key"), line.alias("line")))
    elabel = (
        F.concat(F.lit(" [label="), _q(F.col("label")), F.lit("]"))
        if "label" in edges.columns else F.lit("")
    )
    e = edges.select(
        F.lit(2).alias("seq"), F.concat_ws("\u0001", F.col("src").cast("string"), F.col("dst").cast("string")).alias("key"),
        F.concat(F.lit("  "), _q(F.col("src")), F.lit(arrow), _q(F.col("dst")), F.coalesce(elabel, F.lit("")), F.lit(";")).alias("line"),
    )
    return head.unionByName(n).unionByName(e).unionByName(tail)


def write_dot(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write DOT lines in order. Output files are range-partitioned by (seq, key), so
    concatenating the part files in name order gives the document."""
    lines.repartitionByRange("seq", "key").sortWithinPartitions("seq", "key").select("line").write.mode(mode).text(path)
