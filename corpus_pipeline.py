"""A corpus in five stages: quality, exact copies, near copies, benchmark passages, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's result to the
shared folder and reads it again as the next one's docs. The first four return the columns of documents;
the last adds ``mix_rate``, the rate at which a document is to be drawn, and leaves out rate 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm.common import table, written
from flowlens.llm.decontaminate import drop_contaminated
from flowlens.llm.exact_dedup import keep_one_copy
from flowlens.llm.mixing import with_rates
from flowlens.llm.parity_join import keep_one_of_near_copies
from flowlens.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_copy(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_rates(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
]

#: The quality model, the near-copy components and the fitted rates have no SQL form; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
