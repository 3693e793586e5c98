"""Token counts, token shards, the pipeline and the registered queries' SQL."""

import duckdb
import helpers
import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline
from quintacube.llm import decontamination, queries, simhash, token_count, token_shards

SF = "/root/testdata/sf0.01"
MODEL = P.path("piece_bpe_32k.model")
HARD = [
    None, "", " ", "a", "  a b\n\nc  ", "a\tb", "<s>hi</s>", "▁x", "a▁b", "\n", "a \n b", "x" * 500, "日本語 テスト", "<unk> <0x0A>",
    "a" + " " * 40 + "b", "\r\n x", "é ﬁ ½   　 z​", "it's we'll  don't\n\n\n x", "1234 abc123 !!! \n\n", "a\x85b", "a\x1c b", "x  \n",
]


def test_token_counts_equal_the_library(spark):
    model = token_count.load_model(MODEL)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op5_token_count(spark, SF).collect()}
    for d in docs:
        n = len(model.encode(d.text))
        assert (got[d.doc_id].n_bytes, got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (len(d.text.encode()), n, n > 4096)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_of_hard_texts(spark, name):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs, P.path(name)).collect()}
    whole = token_count.whole_counter(P.path(name))([t or "" for t in HARD])
    assert [got[i] for i in range(len(HARD))] == whole


@pytest.mark.parametrize("extra", [False, True])
def test_token_counts_of_odd_rows(spark, extra):
    docs = helpers.documents(spark, helpers.ODD, extra)
    rows = token_count.count_tokens(docs, MODEL).collect()
    assert len(rows) == len(helpers.ODD) and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert [r.over_limit for r in rows if r.doc_id == 5] == [True]
    assert token_count.count_tokens(docs.where("false"), MODEL).count() == 0


def test_workers_keep_short_pieces_over_their_tasks_and_no_long_ones(spark):
    import pyarrow as pa

    word, model = "wxyz" * (10 << 18), token_count.load_model(MODEL)  # 10 MB without a space
    texts = [f"some text {word} {word[:100]}", "some more text"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts), pa.array([0, 0])], ["doc_id", "text", "n_bytes"])
    count = token_count._counts(MODEL, {})
    got = [next(count(iter([batch]))).column(2).to_pylist() for _ in range(2)]
    kept = token_count.lengths(MODEL, {})
    assert got[0] == got[1] == [len(model.encode(t)) for t in texts]
    assert "▁more" in kept and max(map(len, kept)) <= token_count.PIECE_CHARS
    docs = spark.createDataFrame(list(enumerate(texts * 3)), "doc_id long, text string")
    assert set(token_count.frequent_pieces(docs, "text")) == {"▁some", "▁text", "▁more"}
    ids = token_shards.chunk_ids(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert ids is token_shards.chunk_ids(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert ids[" more"] == ids[" more"] and len(ids["xyz" * 100]) > 0 and " more" in ids and "xyz" * 100 not in ids


def test_sketches_are_merged_where_a_task_gets_none(spark):
    """A file of sketches that is split among tasks leaves some of them without a row."""
    words = [(i, " ".join(f"w{i % 50}x{j}" for j in range(40)) + " all all") for i in range(40)]
    docs = spark.createDataFrame(words, "doc_id long, text string").repartition(3)
    held = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "64"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        assert token_count.frequent_pieces(docs, "text", 1, 500) == ["▁all"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 7, 1000, 65_537):
        assert sorted(token_shards.feistel(np.arange(n), n).tolist()) == list(range(n))
    assert token_shards.feistel(np.arange(50), 50, key=1).tolist() != token_shards.feistel(np.arange(50), 50, key=2).tolist()


def shards_of(spark, docs, folder, length=16, per_shard=10):
    vocabulary = P.path("byte_bpe_50k.tiktoken")
    made = token_shards.materialise(docs, vocabulary, P.PATTERN, folder, length=length, per_shard=per_shard)
    return sorted(made.collect(), key=lambda r: r.slot), token_shards.load_ranks(vocabulary, P.PATTERN)


def test_token_shards_give_back_every_document(spark, tmp_path):
    texts = [*HARD, *(helpers.prose(k, 3 * k) for k in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows, (encoding, end) = shards_of(spark, docs, str(tmp_path / "shards"))
    kind = token_shards.id_type(end + 1)
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert [r.byte_offset for r in rows] == [r.slot % 10 * 16 * kind.itemsize for r in rows]
    ids = token_shards.read_sequences(str(tmp_path / "shards"), 0, len(rows), kind, 16, 10)
    assert ids.shape == (len(rows), 16)
    wanted = {i: [*encoding.encode_ordinary(t or ""), end] for i, t in enumerate(texts)}
    found = {}  # a document's parts stand in sequences that share it; each is found in its tokens
    for r, sequence in zip(rows, ids.tolist(), strict=True):
        bounds = [*r.starts, r.n_tokens]
        for doc, a, z in zip(r.doc_ids, bounds, bounds[1:], strict=False):
            found.setdefault(doc, []).append(sequence[a:z])
        assert set(sequence[r.n_tokens :]) <= {end}
    assert found.keys() == wanted.keys()
    for doc, parts in found.items():
        assert sum(map(len, parts)) == len(wanted[doc])
        text = wanted[doc]
        assert all(any(text[k : k + len(p)] == p for k in range(len(text))) for p in parts)
    middle = token_shards.read_sequences(str(tmp_path / "shards"), 7, 8, kind, 16, 10)
    assert middle.tolist() == ids[7:15].tolist()


@pytest.mark.parametrize("extra", [False, True])
def test_token_shards_of_odd_rows(spark, extra, tmp_path):
    docs = helpers.documents(spark, helpers.ODD, extra)
    rows, _ = shards_of(spark, docs, str(tmp_path / "a"), length=512, per_shard=1 << 10)
    held = [d for r in rows for d, s in zip(r.doc_ids, r.starts, strict=True)]
    assert set(held) == {1, 2, 3, 4, 5, 6, None} and held.count(3) >= 2
    assert shards_of(spark, docs.where("false"), str(tmp_path / "b"))[0] == []


def test_token_shards_query_covers_every_document(spark):
    rows = queries.op8_token_shards(spark, SF).collect()
    assert {d for r in rows for d in r.doc_ids} == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.slot for r in rows) == list(range(len(rows)))


@pytest.mark.parametrize("name", [n for n in queries.ORACLE if not n.startswith("op2")])
def test_query_equals_its_sql(spark, name):
    import compare

    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    assert compare.normal([tuple(r) for r in got.collect()], got.columns) == compare.normal(want.fetchall(), [d[0] for d in want.description])


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stages, now = dict(corpus_pipeline.STAGES), docs
    assert list(stages) == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "sharding"]
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, SF).cache()
        after = [r.doc_id for r in now.collect()]
        assert now.columns == docs.columns and len(after) == len(set(after)) and set(after) <= before
        gone = before - set(after)
        if name == "quality classifier":
            assert sum(labels.get(i) == 1 for i in gone) <= 3 and sum(labels.get(i) == 0 for i in after) <= 3
        if name == "SimHash near-dedup":
            given = simhash.near_duplicates(docs.where(docs.doc_id.isin(list(before))))
            assert sorted(after) == sorted({r.component_id for r in given.collect()})
        if name == "benchmark decontamination":
            assert decontamination.find_leaks(now, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        before = set(after)
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.collect()} <= before
    assert {"shard", "shard_bytes"} <= set(out.columns)
