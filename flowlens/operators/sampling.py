"""Splitting, sampling and rebalancing.

Every random choice is a seeded MD5 of the row key (``ranking.hash_key``), so results do not
depend on partitioning, survive task retries unchanged, and can be reproduced in SQL.
``key`` must identify a row; ``tie`` columns order rows with equal hashes (duplicated keys).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.ranking import first_n, first_n_flag, fraction_sample, hash_key, hash_unit
from flowlens.session import written_once

HASH = "_h"


#: Most rows that a sample takes by top-n instead of by the boundary key; a bound on the parameter n, not on the data.
TOP_ROWS = 10_000


def _hashed(df: DataFrame, key: Sequence[str] | str, seed: int) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(HASH, hash_key(seed, *keys))


def random_split(df: DataFrame, key: Sequence[str] | str, train_fraction: float = 0.8, seed: int = 42,
                 flag: str = "is_train") -> DataFrame:
    """M1: exactly ``int(train_fraction × n)`` rows flagged as train, chosen by hash order."""
    h = _hashed(df, key, seed)
    return first_n_flag(h, HASH, None, (), flag, fraction=train_fraction).drop(HASH)


def stratified_split(df: DataFrame, key: Sequence[str] | str, label: str, test_size: float = 0.2, seed: int = 42,
                     flag: str = "is_train", once: Sequence[str] = ()) -> DataFrame:
    """M2/M3: per class, exactly ``int(n_c × (1 - test_size))`` rows flagged as train.

    For a result that is read several times, the columns ``once`` (the label among them) are written with their rows'
    hashes: the split and its readers then take these, and ``df`` is read and its keys are hashed once.
    """
    h = _hashed(df, key, seed)
    if once:
        h = written_once(h.select(HASH, *once), "split")
    return first_n_flag(h, HASH, None, [label], flag, fraction=1.0 - test_size).drop(HASH)


def sample_n(df: DataFrame, key: Sequence[str] | str, n: int | DataFrame, seed: int = 42, group: Sequence[str] = ()) -> DataFrame:
    """M4/H7: exactly n rows (per group if given) — the n smallest seeded hashes.

    Without groups, a number of rows that a task can hold is a top-n: one run of ``df``, n rows a task.
    """
    if not group and isinstance(n, int) and n <= TOP_ROWS:
        keys = [key] if isinstance(key, str) else list(key)
        return _hashed(df, key, seed).orderBy(HASH, *keys).limit(n).drop(HASH)
    return first_n(_hashed(df, key, seed), HASH, n, group).drop(HASH)


def sample_fraction(df: DataFrame, key: Sequence[str] | str, fraction: float, seed: int = 42) -> DataFrame:
    """M5: each row kept with probability ``fraction`` (deterministic per key and seed)."""
    return fraction_sample(_hashed(df, key, seed), HASH, fraction).drop(HASH)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the class share."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    tot = c.agg(F.sum("count").alias("_t"))  # one row
    return c.join(F.broadcast(tot), how="cross").select(label, "count", F.round(F.col("count") / F.col("_t"), 6).alias("share"))


def undersample_to_minority(df: DataFrame, key: Sequence[str] | str, label: str, seed: int = 42) -> DataFrame:
    """M6: keep the minority class whole; sample the majority with fraction n_min / n_maj.

    Either class may be the majority. Class counts are one small aggregate (two rows),
    attached by a broadcast join; the sample itself is a hash threshold (no shuffle).
    """
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    mm = c.agg(F.min("_n").alias("_min"), F.max("_n").alias("_max"), F.min_by(label, F.struct("_n", label)).alias("_minority"))
    h = _hashed(df, key, seed).join(F.broadcast(mm), how="cross")
    frac = F.col("_min") / F.col("_max")
    keep = (F.col(label) == F.col("_minority")) | (hash_unit(HASH) < frac)
    return h.filter(keep).drop(HASH, "_min", "_max", "_minority")


def undersample_ratio(df: DataFrame, key: Sequence[str] | str, label: str, ratio: float = 1.0, seed: int = 42,
                      minority: int = 1, majority: int = 0) -> DataFrame:
    """M7/M8: all minority rows plus exactly ``int(n_min / ratio)`` majority rows (hash order)."""
    h = _hashed(df, key, seed)
    n_min = h.filter(F.col(label) == minority).agg(F.floor(F.count(F.lit(1)) / F.lit(float(ratio))).cast("bigint").alias("n"))
    targets = n_min.select(F.lit(majority).cast(df.schema[label].dataType).alias(label), "n")
    maj = first_n(h.filter(F.col(label) == majority), HASH, targets, [label])
    return h.filter(F.col(label) == minority).unionByName(maj).drop(HASH)


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Sample weight n / (2 · n_c) for the row's class (broadcast join of class counts)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = c.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = c.join(F.broadcast(tot), how="cross").select(label, (F.col("_n") / (F.lit(2.0) * F.col("_nc"))).alias(name))
    return df.join(F.broadcast(w), label, "left")


def curated_subset(df: DataFrame, key: Sequence[str] | str, label: str, head_pct: dict, sample_n_: dict,
                   seed: int = 42, head_seed: str = "head") -> DataFrame:
    """Of each class the first rows in a stable order, ``head_pct[c]`` per cent of *all* rows, then exactly
    ``sample_n_[c]`` of those per class by seeded hash.

    A distributed table has no file order; the stable order is a second seeded hash of the key
    (``head_seed``), so "head" is reproducible under any partitioning.
    """
    spark = df.sparkSession
    lab_type = df.schema[label].dataType.simpleString()
    total = df.count()
    head_t = spark.createDataFrame([(c, total * int(p) // 100) for c, p in head_pct.items()], f"{label} {lab_type}, n bigint")
    samp_t = spark.createDataFrame([(c, int(n)) for c, n in sample_n_.items()], f"{label} {lab_type}, n bigint")
    keys = [key] if isinstance(key, str) else list(key)
    head = first_n(df.withColumn(HASH, hash_key(head_seed, *keys)), HASH, head_t, [label]).drop(HASH)
    return sample_n(head, key, samp_t, seed, [label])
