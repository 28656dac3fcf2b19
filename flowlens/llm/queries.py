"""Queries over the given tables, one for each operator: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.common import table
from flowlens.llm.decontaminate import benchmark_overlaps
from flowlens.llm.exact_dedup import exact_dedup
from flowlens.llm.hard_negatives import hard_negatives
from flowlens.llm.language import language_id
from flowlens.llm.lm_score import cross_entropy_difference
from flowlens.llm.mixing import mix
from flowlens.llm.paragraphs import repeated_spans
from flowlens.llm.parity_join import near_copies
from flowlens.llm.periodic import planted, run_digests
from flowlens.llm.quality import quality
from flowlens.llm.secret_scan import secret_digests
from flowlens.llm.secret_sql import SECRETS_SQL
from flowlens.llm.token_counts import token_counts
from flowlens.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": lambda spark, d: quality(table(spark, d, "documents"), table(spark, d, "labels")),
    "op2_lm_score": lambda spark, d: cross_entropy_difference(
        table(spark, d, "documents"), table(spark, d, "labels").where("quality = 1 and coalesce(toxic, 0) = 0")
    ),
    "op3_mixing": lambda spark, d: mix(table(spark, d, "documents"), table(spark, d, "labels")),
    "op4_toxicity": lambda spark, d: toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op5_language_id": lambda spark, d: language_id(table(spark, d, "documents")),
    "op6_exact_dedup": lambda spark, d: exact_dedup(table(spark, d, "documents")),
    "op7_paragraph_dedup": lambda spark, d: repeated_spans(table(spark, d, "documents")),
    "op8_decontaminate": lambda spark, d: benchmark_overlaps(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op9_parity_join": lambda spark, d: near_copies(table(spark, d, "documents")),
    "op10_token_counts": lambda spark, d: token_counts(table(spark, d, "documents")),
    "op11_hard_negatives": lambda spark, d: hard_negatives(
        table(spark, d, "embeddings"), F.expr("vec_id % 100 = 0"), F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    ),
    "op12_secret_scan": lambda spark, d: secret_digests(table(spark, d, "documents")),
    "op13_periodic_runs": lambda spark, d: run_digests(table(spark, d, "documents"), alter=planted),
}

#: DuckDB twins of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op6_exact_dedup": r"""
        WITH k AS (
          SELECT doc_id, length(coalesce(text, '')) AS points,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
        FROM (SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                     first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id
              FROM k)""",
    "op11_hard_negatives": r"""
        WITH one AS (
          SELECT vec_id, min(struct_pack(label := label, v := v)) AS r FROM (
            SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
          GROUP BY vec_id),
        rows AS (SELECT vec_id, r.label AS label, r.v AS v FROM one),
        scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
          FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
          SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
    "op12_secret_scan": SECRETS_SQL,
}
