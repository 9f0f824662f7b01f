"""The text operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.llm import (
    class_lm, decontaminate, jaccard, langid, licenses, line_dedup, packing, quality, resample, secrets, simhash, substring_dedup,
    token_align,
)
from postpulse.llm.common import crc_mod, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(run):
    QUERIES[run.__name__] = run
    return run


def documents(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


@register
def op1_line_dedup(spark, folder):
    kept = line_dedup.drop_repeated_runs(documents(spark, folder), keep_empty=True, least=line_dedup.LEAST)
    lines = F.filter(F.split("text", "\n"), line_dedup.filled)
    return kept.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_kept"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


@register
def op2_decontamination(spark, folder):
    found = decontaminate.find_contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), F.col("n_hit").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op3_best_fit_packing(spark, folder):
    return packing.pack_documents(documents(spark, folder))


@register
def op4_ngram_jaccard_join(spark, folder):
    return jaccard.jaccard_classes(documents(spark, folder))


@register
def op5_lm_scoring(spark, folder):
    docs = documents(spark, folder)
    held = crc_mod(F.col("doc_id"), 7) == 2
    return class_lm.score(docs, ~held).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


@register
def op6_license_scan(spark, folder):
    return licenses.scan_licenses(documents(spark, folder)).select(
        "doc_id", F.array_join("licenses", ",").alias("licenses"), "whole_text", "n_lines"
    )


@register
def op7_secret_scan(spark, folder):
    found = secrets.find_secrets(documents(spark, folder))
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] != "format")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, as_text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", as_text), ",").alias("spans"),
    )


@register
def op8_simhash(spark, folder):
    return simhash.fingerprint_documents(documents(spark, folder))


@register
def op9_language_id(spark, folder):
    docs = documents(spark, folder)
    held = crc_mod(F.col("doc_id"), 5) == 0
    model = langid.fit(docs.where(~held))
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@register
def op10_substring_dedup(spark, folder):
    return substring_dedup.remove_repeats(documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@register
def op11_token_alignment(spark, folder):
    return token_align.alignment_counts(documents(spark, folder)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@register
def op12_importance_resampling(spark, folder):
    found = resample.importance_resample(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@register
def op13_quality(spark, folder):
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    held = crc_mod(F.col("doc_id"), 5) == 0
    model = quality.fit(docs, labels.where(~held))
    return quality.score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
