"""A training corpus from raw documents, in stages that each take over what the last one kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quintacube.llm import decontamination, mixing, quality_mil, sharding, simhash
from quintacube.llm.queries import SHARD_BYTES
from quintacube.functions.sizing import temporary_tables
from quintacube.session import ensure_checkpoint_dir
from quintacube.sources.files import remove


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by all labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_mil.accepted(docs, quality_mil.learn(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that SimHash links (four-word shingles, four bits)."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents dropped or repeated until each source has its target share."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard of at most `SHARD_BYTES` that each belongs to."""
    return sharding.shard_documents(docs, SHARD_BYTES)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("sharding", shard),
]

#: Learned scores and seeded selections are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline/{uuid.uuid4()}"
    for number, (_, stage) in enumerate(STAGES):
        with temporary_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            remove(spark, f"{folder}/{number - 1}")
    return docs
