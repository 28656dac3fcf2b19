"""Session helpers.

Library code never creates its own session; it takes the caller's. ``local_session`` is for
tests and the bench only. ``ensure_checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session; only
in local mode, where one machine is driver and executors, it sets a folder of its own if there is none. On
a cluster without the setting it raises.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "flowlens", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Bytes of a batch that goes to or comes from a Python worker, at most (or one row).
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> SparkSession:
    """Lower Spark's own bound of a batch to a Python worker (64 MB, doubled while a column of long values grows)
    to ``BATCH_BYTES``, if it isn't lower already."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(bound).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(bound, str(BATCH_BYTES))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster, setting a local one only if unset."""
    current = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="flowlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set(_CHECKPOINT_KEY, local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, a job's shuffle files are removed when it has ended, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was) if was is not None else spark.conf.unset(key)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """df as a compressed table in the shared checkpoint folder, read back: for what is read often and costs much to work out."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = [path]
    return table


def drop_written(*tables: DataFrame) -> None:
    """Delete tables of ``written_once`` that nothing reads any more."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        for p in t.written_to:
            path = sc._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
