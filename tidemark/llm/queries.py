"""The queries of this subpackage, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, covertree, hnsw, packing, pii, quality, records, simhash, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): every document, its entities replaced."""
    return pii.replace_entities(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(_table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op7_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_products(_table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coded(_table(spark, sf_dir, "documents"), ["n_tokens", "ids_sha256", "decoded_sha256"])


def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_pii_surrogates, op2_simhash, op3_toxicity, op4_warc, op5_hnsw, op6_packing, op7_covertree, op8_quality, op9_bpe, op10_records, pipeline]
    return {f.__name__: f for f in own}


# Exact top-k is the one of these that SQL can express at a bearable cost.
ORACLE_SQL = {
    "op7_covertree": """
        WITH v AS (
            SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}


def oracle_sql() -> dict[str, str]:
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL

    return ORACLE_SQL | ({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})
