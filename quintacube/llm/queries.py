"""Registered queries of the operators, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.llm import (
    decontamination,
    fill_in_middle,
    filter_audit,
    license_scan,
    mixing,
    piece_ids,
    quality_mil,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    token_count,
    token_shards,
)

SHARD_BYTES = 1 << 20


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_read(spark, sf_dir, "documents"), license_scan.templates(spark))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = quality_mil.learn(docs, labels.where(~held_out))
    return quality_mil.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(
        _read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.materialise(
        _read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        token_shards.new_folder(spark),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), SHARD_BYTES, keep=["doc_id"])


def op11_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_ids.encode(_read(spark, sf_dir, "documents"), model)
    return piece_ids.decode(coded, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle.restored(fill_in_middle.fill_in_middle(_read(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_source_mixing": op4_source_mixing,
    "op5_token_count": op5_token_count,
    "op6_simhash": op6_simhash,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_token_shards": op8_token_shards,
    "op9_quality_rules": op9_quality_rules,
    "op10_sharding": op10_sharding,
    "op11_piece_round_trip": op11_piece_round_trip,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE = {
    "op1_license_scan": license_scan.oracle_sql(),
    "op2_suffix_array_dedup": substring_dedup.oracle_sql(),
    "op10_sharding": sharding.oracle_sql(SHARD_BYTES),
    "op12_fill_in_middle": fill_in_middle.oracle_sql(),
    "op13_filter_audit": filter_audit.oracle_sql(),
}
