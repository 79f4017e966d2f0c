"""One query per operator: production parameters, whole tables, whole texts, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import (
    centroids, decontaminate, exact, licenses, lm, neardup, packing, pii, quality, resample, sentencepieces, urls, warc,
)
from palimpsest.storage import session_scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.dedup(_table(spark, sf_dir, "documents"), session_scratch(spark))
    return found.withColumnRenamed("id", "doc_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), session_scratch(spark)).withColumnRenamed("id", "doc_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    coded = sentencepieces.round_trip(_table(spark, sf_dir, "documents"))
    text = F.translate(F.coalesce("text", F.lit("")), sentencepieces.MARK, " ")
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_pieces"),
        "ids_crc32",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == text).alias("round_trip"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, sf_dir, "documents"), session_scratch(spark))
    return found.withColumnRenamed("id", "doc_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), session_scratch(spark))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.judge_quality(docs, labels, session_scratch(spark)).withColumnRenamed("id", "doc_id")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), session_scratch(spark))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), session_scratch(spark)).withColumnRenamed("id", "doc_id")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(_table(spark, sf_dir, "embeddings"), session_scratch(spark))
    return found.withColumnRenamed("id", "vec_id").drop("centroid")


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), session_scratch(spark))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", decontaminate.items_sha256().alias("items_sha256"), "contaminated"
    )


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), session_scratch(spark))
    return found.withColumnRenamed("id", "doc_id").drop("n_words")


# The columns of operators 1, 5, 8, 9 and 10 that SQL can express.


def base_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def base_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def base_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_quality(spark, sf_dir).drop("score", "kept")


def base_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the verdicts of rules only."""
    ruled = F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("verdict")
    return op9_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", ruled)


def base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores to three places, as sums of floats depend on their order."""
    rounded = F.round("base_score", 3).alias("base_score")
    return op10_lm_score(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", rounded)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_exact_dedup, op3_packing, op4_sentencepiece, op5_licenses, op6_near_dedup, op7_warc, op8_quality,
        op9_url_filter, op10_lm_score, op11_centroids, op12_decontaminate, op13_resample,
        base_pii, base_licenses, base_quality, base_urls, base_scores,
    )
}
