"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import exact, html, langid, lm, merkle, mixing, near, oracle, packing, quality, toxicity, urls, warc, whitening
from changeloom.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_main_text(spark: SparkSession, d: str) -> DataFrame:
    pages = read_table(spark, d, "pages", ["page_id", "url", "html"])
    return html.main_text(pages).select("page_id", "url", "text", "n_chars")


def op2_language_id(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(read_table(spark, d, "documents", ["doc_id", "text", "lang"]))


def op3_lm_score(spark: SparkSession, d: str) -> DataFrame:
    return lm.score_texts(read_table(spark, d, "documents", ["doc_id", "text"]))


def op4_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near.near_duplicates(read_table(spark, d, "documents", ["doc_id", "text"]))


def op5_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return exact.exact_dedup(docs, keep="largest").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha256")).alias("text_sha256"))


def op6_warc(spark: SparkSession, d: str) -> DataFrame:
    pages = read_table(spark, d, "pages", ["page_id", "url", "html"])
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest",
                                         "record_type", "refers_to")


def op7_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text", "source"])
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = read_table(spark, d, "pages", ["page_id", "url"])
    return urls.judge_urls(pages, urls.rule_table(spark))


def op9_packing(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return packing.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op10_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    judged = quality.quality_filter(docs, measured=True)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", base_failed.alias("base_failed"), "kept")


def op11_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", merkle.FIELDS)
    return merkle.manifest(docs, check=merkle.line_feeds_deleted()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return toxicity.toxicity(docs, read_table(spark, d, "labels", ["doc_id", "toxic"]))


def op13_whiten_embeddings(spark: SparkSession, d: str) -> DataFrame:
    vectors = read_table(spark, d, "embeddings", ["vec_id", "embedding"])
    # A squared distance too large for a long is null here.
    return whitening.whiten(vectors).withColumn("deviation", F.col("deviation").try_cast("bigint"))


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_main_text, op2_language_id, op3_lm_score, op4_near_dedup, op5_exact_dedup, op6_warc, op7_mix_sources, op8_url_filter,
        op9_packing, op10_quality_rules, op11_merkle_manifest, op12_toxicity,
        op13_whiten_embeddings)}


def oracle_queries() -> dict[str, str]:
    return oracle.ORACLE_SQL
