"""Incremental sales totals over a file stream of line items.

The batch operators are reused unchanged on a streaming DataFrame: new line-item files are
read as they land, dimension tables are joined stream-static, and the aggregate state is kept
by Spark in the checkpoint (under the session's shared ``spark.checkpoint.dir``), so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.columns import money_sum
from flowlens.session import ensure_checkpoint_dir
from flowlens.sources.readers import read_table


def lineitem_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1, glob: str = "lineitem*.parquet") -> DataFrame:
    """New line-item files landing in ``sf_dir`` (matched by ``glob``) as a stream."""
    schema = read_table(spark, sf_dir, "lineitem").schema
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("pathGlobFilter", glob)
        .parquet(sf_dir.rstrip("/"))
    )


def monthly_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SL2 over a stream: calendar-month totals, updated per micro-batch (complete mode)."""
    li = lineitem_stream(spark, sf_dir)
    return li.groupBy(F.month(F.to_date("l_shipdate")).alias("month")).agg(money_sum("l_extendedprice").alias("monthly_total_sales"))


def county_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 over a stream: totals per customer nation via stream-static joins."""
    li = lineitem_stream(spark, sf_dir).select("l_orderkey", "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    dim = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        F.broadcast(nation), customer.c_nationkey == nation.n_nationkey, "left"
    ).select("o_orderkey", F.col("n_name").alias("county"))
    return li.join(dim, li.l_orderkey == dim.o_orderkey, "left").groupBy("county").agg(
        money_sum("l_extendedprice").alias("sales")
    )


def run_to_table(df: DataFrame, name: str | None = None, output_mode: str = "complete") -> DataFrame:
    """Drive a streaming aggregate to completion over what is available and return the result."""
    spark = df.sparkSession
    name = name or f"flowlens_stream_{uuid.uuid4().hex[:8]}"
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    q = (
        df.writeStream.format("memory").queryName(name).outputMode(output_mode)
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.table(name)
