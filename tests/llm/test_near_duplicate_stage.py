"""The pipeline's near-duplicate, mixing and sharding stages: whose rows stay, and that reruns agree."""

import random
from collections import Counter

import helpers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quintacube.llm import mixing, places, sharding, simhash

#: Names that are used beside the input's columns somewhere inside.
RESERVED = [
    "row", "file", "at", "tie", "fp", "root", "node", "first", "component_id", "copies", "nth", "address", "_order", "_source", "_shard",
    "_file", "_row", "_copies", "_copy", "_address", "_fit", "_leaf", "_depth", "block", "begin", "inside", "no_id", "size", "n", "key", "b c", "d.e", "_metadata",
]


def edited(text, seed, places_):
    rng, w = random.Random(seed), text.split()
    for k in range(places_):
        w[rng.randrange(len(w))] = f"edit{seed}x{k}"
    return " ".join(w)


def by_hand(rows):
    """Groups of rows (id, text) whose fingerprints link at 4 bits, by comparing all pairs."""
    prints = simhash.fingerprints([t for _, t in rows]).tolist()
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= simhash.RADIUS:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))]


def corpus():
    texts = [helpers.prose(k, 120) for k in range(30)]
    texts += [edited(texts[k], 100 + k, k % 3) for k in range(30)]
    texts += [edited(texts[0], 300 + k, k % 2) for k in range(40)] + [texts[1].upper(), None, "", "two words", "two  words"]
    return list(enumerate(texts))


def test_stage_keeps_the_smallest_id_of_each_linked_group(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, None)
    wanted = sorted(set(by_hand(rows)))
    assert sorted(r.doc_id for r in kept.collect()) == wanted and 30 < len(wanted) < 100


def test_stage_agrees_with_the_operator(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    groups = simhash.near_duplicates(docs).collect()
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted({r.component_id for r in groups})


def test_stage_decides_by_row_where_ids_repeat_or_are_missing(spark):
    one, two = helpers.prose(1, 200), helpers.prose(2, 200)
    rows = [(1, two), (5, one), (5, two), (None, two + " end"), (None, helpers.prose(3, 90)), (None, helpers.prose(3, 90)), (7, one), (7, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.keep_one(docs).collect()
    assert len(set(by_hand(rows))) == 3
    assert Counter(tuple(r) for r in kept) == Counter([rows[0], rows[1], rows[4]])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.mix, corpus_pipeline.shard):
        assert stage(spark, docs, None).count() == 0


@pytest.mark.parametrize("stored", [False, True])
def test_no_input_column_can_clash(spark, tmp_path, stored):
    docs = spark.createDataFrame([(k, helpers.prose(k % 20, 40), "ab"[k % 2]) for k in range(60)], "doc_id long, text string, source string")
    wide = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in RESERVED])
    if stored:
        wide.write.parquet(str(tmp_path / "docs"))
        wide = spark.read.parquet(str(tmp_path / "docs"))
    whole = {r.doc_id: tuple(r) for r in wide.collect()}
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.mix, corpus_pipeline.shard):
        out = stage(spark, wide, None)
        assert out.columns[: len(wide.columns)] == wide.columns
        found = out.collect()
        assert found and all(tuple(r)[: len(wide.columns)] == whole[r.doc_id] for r in found)


def odd_rows():
    rows = [(None, helpers.prose(k, 40), "a") for k in range(20)] + [(7, helpers.prose(k, 40), "b") for k in range(50, 60)]
    return rows + [(k, helpers.prose(k, 40), "c") for k in range(100, 140)] + [(200, "same row " * 20, "a")] * 45


def test_mixing_stage_copies_rows_with_null_and_repeated_ids_at_most_three_times(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = corpus_pipeline.mix(spark, docs, None)
    assert out.columns == docs.columns
    copies, given = Counter(tuple(r) for r in out.collect()), Counter(rows)
    assert set(copies) <= set(given) and all(n <= mixing.MOST_PASSES * given[r] for r, n in copies.items())
    mixed = mixing.mix(docs, shard_words=200)
    assert mixed.count() == len(rows) and mixed.where("taken > 3 * size").count() == 0


def test_reruns_agree_wherever_the_rows_are_stored(spark, monkeypatch):
    monkeypatch.setattr(places, "NUMBERED_ROWS", 4)
    rows = odd_rows()
    mixes, stays, shards = [], [], []
    for seed, parts in ((1, 1), (2, 5)):
        shuffled = random.Random(seed).sample(rows, len(rows))
        docs = spark.createDataFrame(shuffled, "doc_id long, text string, source string").repartition(parts)
        mixes.append(Counter(tuple(r) for r in mixing.mix(docs, shard_words=200).collect()))
        stays.append(Counter(tuple(r) for r in simhash.keep_one(docs).collect()))
        shards.append(Counter(tuple(r) for r in sharding.shard_documents(docs, 600).collect()))
    assert mixes[0] == mixes[1] and stays[0] == stays[1] and shards[0] == shards[1]


def test_equal_rows_are_numbered_once_each(spark, monkeypatch):
    monkeypatch.setattr(places, "NUMBERED_ROWS", 3)
    docs = spark.createDataFrame([(k % 4,) for k in range(50)], "k long").repartition(3)
    rows = places.placed(docs).select(F.col("row.k").alias("k"), "file", "at")
    numbers = rows.join(places.numbered_among_equals(rows, "k"), ["file", "at"])
    found = sorted((r.k, r.nth) for r in numbers.collect())
    assert found == sorted((k, n) for k, m in Counter(i % 4 for i in range(50)).items() for n in range(m))
