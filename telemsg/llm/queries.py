"""Registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_dedup

    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.col("__ld_lines").alias("n_lines"),
        F.col("__ld_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import secret_scan

    return secret_scan(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules

    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import url_filter

    out = url_filter(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import html_extract

    return html_extract(table(spark, sf_dir, "pages"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import lm_score

    return lm_score(table(spark, sf_dir, "documents"))


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    out = round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source", "source_size", "target", "taken")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import code_report

    out = code_report(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import cluster_report

    return cluster_report(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_secret_scan,
        op3_quality_rules,
        op4_url_filter,
        op5_minhash_dedup,
        op6_html_extract,
        op7_lm_score,
        op8_warc_round_trip,
        op9_decontaminate,
        op10_mix_sources,
        op11_vector_codes,
        op12_centroids,
        op13_toxicity,
    )
}
