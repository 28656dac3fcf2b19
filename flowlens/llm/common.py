"""What the operators share on the Spark side: table access, the shared folder, bounded samples."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import BATCH_BYTES, bound_batches, ensure_checkpoint_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns the operators read, so that other columns may have any name."""
    package_reachable(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def package_reachable(spark: SparkSession) -> SparkSession:
    """Prepare the session for Python workers: they import this package, and batches are bounded in bytes.

    On this machine workers import the package from where the driver did; on a cluster it is installed or shipped
    XX of a batch (64 MB, doubled while a
    column of long texts or sets grows) is lowered to ``BATCH_BYTES``, if it isn't lower already.
    """
    bound_batches(spark)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """df as a table in the folder that ``spark.checkpoint.dir`` names, read back: lineage ends there.

    Lost executors then cost a read of the table, not the work before it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1_000_000


def semi_join(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ids (one column of that name): by broadcast while there are at most
    ``BROADCAST_ROWS`` ids (8 bytes each), else by a shuffle join."""
    return _by_ids(rows, ids, key, "left_semi")[0]


def anti_join(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ids; rows with a null key stay."""
    return _by_ids(rows, ids, key, "left_anti")[0]


def marked(rows: DataFrame, ids: DataFrame, key: str, mark: str) -> DataFrame:
    """rows with one more column: whether the key is among ids; a null key is not. What a shuffle join makes is written
    once, as it is read more than once."""
    out, few = _by_ids(rows, ids, key, "left")
    out = out.select(*rows.columns, F.col("_wanted").isNotNull().alias(mark))
    return out if few else written(out, "marked")


def _by_ids(rows: DataFrame, ids: DataFrame, key: str, how: str) -> tuple[DataFrame, bool]:
    """The join, and whether it is by broadcast."""
    ids = written(ids.distinct(), "ids").withColumnRenamed(key, "_wanted")
    few = ids.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(ids) if few else ids, F.col(key) == F.col("_wanted"), how), few


def id_order(col: Column | str) -> Column:
    """A fixed pseudo-random order of ids, 20 bits."""
    return F.pmod(F.xxhash64(F.lit("order"), col), F.lit(1 << 20))


def fold(col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def class_sample(rows: DataFrame, key: str, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class, by id order; all rows of a class that has fewer.

    The classes are those of a labelled table (a handful); the counts alone reach the driver.
    """
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    return rows.where(id_order(key) < share * F.lit(1 << 20))
