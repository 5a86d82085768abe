"""One query for each operator, over its whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.llm import decontamination, exact_dedup, jaccard_join, line_dedup, merkle_manifest, mixing, quality_classifier, quality_rules, sharding, spelling_variants, substring_dedup, suffix_dedup, token_counts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontamination.marked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.marked(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "rules.*").drop("boilerplate")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.taken(documents(spark, sf_dir), labels).select("doc_id", "size", "source_size", "target", "taken")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality_classifier.scored(documents(spark, sf_dir).select("doc_id", "text"), labels)
    return found.select("doc_id", "quality.*")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.without_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "place.*")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.without_repeats(documents(spark, sf_dir))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.counted(docs, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "tokens.*")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.marked(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle_manifest.manifest(documents(spark, sf_dir), *merkle_manifest.tampered())
    shown = found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_mixing": op5_mixing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_line_dedup": op7_line_dedup,
    "op8_sharding": op8_sharding,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}
