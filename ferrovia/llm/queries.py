"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to its whole table and derives the result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrovia.llm import (
    common,
    decontaminate,
    fill_in_middle,
    language_id,
    odd_sketch,
    packing,
    pitman_yor,
    preference,
    quality_rules,
    secrets,
    suffix_dedup,
    token_alignment,
    token_counts,
    url_rules,
)
from ferrovia.llm.oracle import ORACLE


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


TOKEN_LIMIT = 512


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.load(spark, sf_dir, "documents")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pitman_yor.score(_documents(spark, sf_dir))
    return scored.select("doc_id", (common.crc_mod(F.col("doc_id"), 10) == 0).alias("held_out"),
                         "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_documents(spark, sf_dir), common.load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(_documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op6_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(_documents(spark, sf_dir)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_induced_sorting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(_documents(spark, sf_dir))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(_documents(spark, sf_dir))
    return found.select("doc_id", (common.crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"),
                        "lang_pred", "score", "rejected")


def op9_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preference.score(_documents(spark, sf_dir), common.load(spark, sf_dir, "labels"))
    return found.select("doc_id", (common.crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_lines(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lost_chars")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_documents(spark, sf_dir))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(_documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(common.load(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pitman_yor, op2_secrets, op3_packing, op4_decontamination, op5_token_counts, op6_odd_sketch,
        op7_induced_sorting, op8_language_id, op9_preference, op10_quality_rules, op11_fill_in_middle,
        op12_token_alignment, op13_url_rules)}

__all__ = ["ORACLE", "QUERIES", "tokenizer"]
