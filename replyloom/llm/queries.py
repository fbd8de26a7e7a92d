"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.llm import (
    decontamination,
    language,
    mixing,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    secret_scan,
    spelling,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from replyloom.llm.common import held_out, read, spread_rows

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread_rows(read(spark, folder, "documents").select("doc_id", "text"))


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    ledger = quality_rules.rule_ledger(_documents(spark, folder))
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.POLICIES[-1]).alias("kept"),
        "failures",
    )


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.secret_scan(read(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    return found.select(
        "doc_id",
        *[secret_scan.of_kind(spans, i).alias(f"n_{kind}") for i, kind in enumerate(secret_scan.KINDS)],
        F.sha2(secret_scan.as_text(spans, (0, 1, 2)), 256).alias("base_sha256"),
        secret_scan.as_text(spans).alias("spans"),
    )


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scores = toxicity.score_toxicity(_documents(spark, folder), read(spark, folder, "labels"))
    return _scored(scores, toxicity.THRESHOLD)


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread_rows(read(spark, folder, "documents").select("doc_id", "text", "lang"))
    found = language.identify_languages(documents, with_spans=False)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, folder, "pages"))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(_documents(spark, folder), read(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    scores = quality_model.score_quality(_documents(spark, folder), read(spark, folder, "labels"))
    return _scored(scores, quality_model.THRESHOLD)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.warc_round_trip(spread_rows(read(spark, folder, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, folder))


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(spread_rows(read(spark, folder, "embeddings")))


def op12_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, folder)).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    name: run for name, run in globals().items() if name.startswith("op") and callable(run)
}
