"""Operator 6 (DataFrame functions only): exact copies by 128-bit content hash, checked by bytes.

Texts are equal when the same after deleting every character of ``[\\x20\\x09-\\x0D]``; null counts as
empty. Rows are grouped by the MD5 (128 bits) of the normalised text and, inside a hash, by the
normalised bytes themselves, so texts that only share a hash stay apart. Of a group the row with the
most code points in the original text stays, then the smallest id; a null id comes last.

The grouping is a two-step aggregate: each task first reduces its own rows, so a group that holds a
third of all rows sends one row a task. For handing the result back to the rows, groups of at least a
``HOT_SHARE`` of all rows (so at most ``1 / HOT_SHARE`` groups) are broadcast and their rows leave the
join's key alone; no key of the join that is left holds more than that share.

Repeated rows (same id and text) belong to one group and each gets its values; the filter keeps one of
them. An empty table gives an empty result; other columns are carried by the filter and may have any
name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import written

WHITE = " \t\n\v\f\r"
HOT_SHARE = 0.001
BROADCAST_KEYS = 250_000


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = text
    for c in WHITE:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.length(text).alias("points"), bare.alias("bare")
    ).withColumns({"hash": F.unhex(F.md5("bare")), "text_sha256": F.sha2("bare", 256)})


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """hash, text_sha256, keep_id, group_size: one row for each group of equal texts."""
    best = F.struct((-F.col("points")).alias("fewer"), F.col("least").isNull().alias("no_id"), F.col("least").alias("doc_id"))
    return (
        _keys(docs, id_col, text_col)
        .groupBy("hash", "bare", "text_sha256", "points")  # hash and bytes; plain buffers, so no sort
        .agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
        .groupBy("hash", "text_sha256")
        .agg(F.min(best).alias("best"), F.sum("n").alias("group_size"))
        .select("hash", "text_sha256", F.col("best.doc_id").alias("keep_id"), "group_size")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows = _keys(docs, id_col, text_col).select("doc_id", "hash", "text_sha256")
    groups = written(exact_groups(docs, id_col, text_col), "exact-groups").withColumn("found", F.lit(True))
    hot = groups.where(F.col("group_size") >= max(2.0, docs.count() * HOT_SHARE))
    keys = ["hash", "text_sha256"]
    first = rows.join(F.broadcast(hot.select(*keys, *[F.col(c).alias(f"hot_{c}") for c in ("keep_id", "group_size", "found")])), keys, "left")
    own = F.when(F.col("hot_found"), F.unhex(F.md5(F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")))).otherwise(F.col("hash"))
    second = first.withColumn("hash", own).join(groups, keys, "left")
    return second.select(
        "doc_id",
        F.when(F.col("hot_found"), F.col("hot_keep_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("hot_group_size", "group_size").alias("group_size"),
        "text_sha256",
    ).select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")


def keep_one_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; a row given several times (same id, same text) stays once.

    Only ids and hashes are shuffled to find the rows that go; while these are ``BROADCAST_KEYS`` or fewer they are
    broadcast (some 100 bytes each), so no row with its text moves. Beyond that the rows are joined by a shuffle.
    """
    sha, at = "_text_sha256", F.col(id_col).cast("long")
    bare = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    for c in WHITE:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    rows = docs.withColumn(sha, F.sha2(bare, 256))
    kept = exact_groups(docs, id_col, text_col).select(F.col("text_sha256").alias("_kept_sha"), F.col("keep_id").alias("_kept_id"))
    is_kept = (F.col("_sha") == F.col("_kept_sha")) & F.col("_id").eqNullSafe(F.col("_kept_id"))
    pairs = rows.select(at.alias("_id"), F.col(sha).alias("_sha")).groupBy("_id", "_sha").agg(F.count(F.lit(1)).alias("_times"))
    marked = pairs.join(kept.withColumn("_stays", F.lit(True)), is_kept, "left").select("_id", "_sha", "_times", F.col("_stays").isNotNull().alias("_stays"))
    special = written(marked.where("NOT _stays OR _times > 1"), "copies")
    few = special.count() <= BROADCAST_KEYS
    same = (F.col(sha) == F.col("_sha")) & at.eqNullSafe(F.col("_id"))

    def among(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select("_id", "_sha")
        return rows.join(F.broadcast(keys) if few else keys, same, how)

    repeated = special.where("_stays")
    once = among(special, "left_anti")
    return once.union(among(repeated, "left_semi").dropDuplicates([sha, id_col])).drop(sha)
