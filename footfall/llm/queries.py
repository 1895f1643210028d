"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import fill_middle, license_scan, mixing, ngram_join, nn_descent, packing, quality_classifier, quality_rules, spelling_variants, suffix_dedup, toxicity, url_filter, warc
from footfall.llm.shared import learns_from, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_groups(table(spark, sf_dir, "documents")).drop("class_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    judged = url_filter.judge_urls(pages, rules, url_filter.repeated_addresses(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _judged(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scored.select(
        F.col("key").alias("doc_id"), (~learns_from(F.col("key"), folds, held_out)).alias("held_out"), "score", "predicted"
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(learns_from(F.col("doc_id"), 3, 1)).select("doc_id", F.col("toxic").alias("label"))
    return _judged(toxicity.classify(table(spark, sf_dir, "documents"), labels, threshold=0.7), 3, 1)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.removed(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(learns_from(F.col("doc_id"), 5, 0)).select("doc_id", F.col("quality").alias("label"))
    return _judged(quality_classifier.classify(table(spark, sf_dir, "documents"), labels.withColumnRenamed("doc_id", "key"), threshold=0.3), 5, 0)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, recipe = mixing.plan(table(spark, sf_dir, "documents"))
    return mixing.drawn(sized, recipe).select(
        F.col("key").alias("doc_id"),
        F.col("size_").alias("size"),
        F.col("source_size_").alias("source_size"),
        F.col("target_").alias("target"),
        (F.col("size_") * F.size("shards_")).cast("bigint").alias("taken"),
    )


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    judged = quality_rules.judge(documents, quality_rules.fit_ratios(documents, trusted))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return changed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_packing": op2_packing,
        "op3_url_filter": op3_url_filter,
        "op4_toxicity": op4_toxicity,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_mixing": op7_mixing,
        "op8_nn_descent": op8_nn_descent,
        "op9_quality_rules": op9_quality_rules,
        "op10_warc": op10_warc,
        "op11_fill_middle": op11_fill_middle,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_license_scan": op13_license_scan,
    }
