"""Substring deduplication where the reads of one table split its files differently."""

import helpers

from quintacube.llm import substring_dedup


def test_substring_dedup_does_not_depend_on_how_files_are_split(spark, tmp_path):
    texts = [helpers.prose(k % 40, 60) + f" {k}" for k in range(80)]
    path = str(tmp_path / "docs")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows.write.option("parquet.block.size", 4096).parquet(path)
    docs = spark.read.parquet(path)
    wanted = {r.doc_id: bytes(r.kept) for r in substring_dedup.remove_repeats(docs).collect()}
    assert sum(map(len, wanted.values())) < sum(map(len, texts))
    found = substring_dedup.remove_repeats(docs)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
        got = {r.doc_id: bytes(r.kept) for r in found.select("*").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == wanted


def test_blocks_are_shared_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_ROWS", 3)
    docs = spark.createDataFrame([(k, helpers.prose(k % 7, 40)) for k in range(30)], "doc_id long, text string").repartition(2)
    rows = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert all((len(rows[k].kept) == 0) == (k >= 7) for k in range(30))
