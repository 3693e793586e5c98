"""SentencePiece ids by prefix tables, beside the library."""

import hashlib
import random

import helpers
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from quintacube.llm import piece_ids, queries
from quintacube.llm.token_count import load_model

SF = "/root/testdata/sf0.01"
PATH = P.path("piece_bpe_32k.model")
HARD = [
    None, "", " ", "  ", "a", "  a b\n\nc  ", "a\tb", "<s>hi</s>", "▁x", "a▁b", "▁", " ▁ ", "\n", "a \n b", "x" * 500, "日本語 テスト",
    "<unk> <0x0A>", "a" + " " * 40 + "b", "\r\n x", "é ﬁ ½   　 z​", "it's we'll  don't\n\n\n x", "1234 abc123 !!!", "\0a\0", "a\x85b",
    "😀👩‍👩‍👧 ퟿", "======== ----------", "�",
]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def one():
    return piece_ids.codec(PATH), load_model(PATH)


def test_ids_and_texts_equal_the_library(one):
    codec, model = one
    rng = random.Random(4)
    texts = HARD + ["".join(rng.choice("abcdehilnorstABC  \n\t▁é日x1.-") for _ in range(rng.randrange(120))) for _ in range(2000)]
    for text in texts:
        ids = model.encode(text or "")
        assert codec.encode(text).tolist() == ids
        assert codec.decode(ids) == model.decode(ids)


def test_any_ids_decode_as_in_the_library(one):
    codec, model = one
    rng = random.Random(5)
    some = [0, 1, 2, codec.id_of["▁"], codec.id_of["▁▁"]]
    for _ in range(4000):
        ids = [rng.choice([*some, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(9))]
        assert codec.decode(ids) == model.decode(ids)


def test_prefix_table_holds_the_last_token_of_every_prefix(one):
    codec, _ = one
    for part in ("▁internationalisation", "▁▁▁▁▁x", "▁日本", "\nabcabcabc", "▁--------==", "▁ab\u0378c"):
        table = codec.last_tokens(part)
        for end in range(1, len(part) + 1):
            assert codec.merged(part[:end])[0][-1] == codec._piece(table[end - 1])


def test_merging_alone_decides_whether_two_pieces_stay_apart(one):
    codec, model = one
    rng = random.Random(6)
    plain = [p for p in codec.id_of if "▁" not in p]
    short = [p for p in plain if len(p) < 4]
    for k in range(6000):
        some = short if k % 2 else plain
        left, right = rng.choice(some), rng.choice(some)
        if not (codec._made(codec.id_of[left]) and codec._made(codec.id_of[right])):
            continue
        ids = model.encode("\n" + left + right)[2:]  # the space in front and the newline stay apart
        wanted = [codec.id_of[left], codec.id_of[right]]
        assert codec.apart(*wanted) == (ids == wanted) == (codec.merged(left + right)[0] == [left, right])


def test_long_texts_without_a_cut(one):
    codec, model = one
    rng = random.Random(7)
    for text in ("x" * 300_000, " " * 50_000, "".join(rng.choice("abcdefgh") for _ in range(100_000)), "日é" * 30_000):
        ids = codec.encode(text).tolist()
        assert ids == model.encode(text) and codec.decode(ids) == text
    assert all(len(part) <= piece_ids.PART_CHARS for part in codec._parts)


def test_what_a_worker_keeps_is_bounded(monkeypatch):
    monkeypatch.setattr(piece_ids, "PARTS", 10)
    monkeypatch.setattr(piece_ids, "PAIRS", 20)
    codec, model = piece_ids.Codec(PATH), load_model(PATH)
    text = helpers.prose(1, 300)
    assert codec.encode(text).tolist() == model.encode(text)
    assert len(codec._parts) <= 10 and len(codec._apart) <= 20


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, one, extra):
    docs = helpers.documents(spark, helpers.ODD, extra)
    if extra:
        docs = docs.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x")).withColumn("n_tokens", F.lit(2))
    rows = piece_ids.decode(piece_ids.encode(docs, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in rows) == sorted((str(i), t or "") for i, t, _ in helpers.ODD)
    assert {tuple(r.ids) for r in rows if r.doc_id in (1, 2)} == {()}
    empty = piece_ids.decode(piece_ids.encode(docs.where("false"), PATH), PATH)
    assert empty.count() == 0 and empty.columns == ["doc_id", "ids", "decoded"]
    with pytest.raises(ValueError):
        piece_ids.decode(piece_ids.encode(docs, PATH), PATH, name="ids")


def test_rows_without_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "k long, ids array<int>")
    assert [r.decoded for r in piece_ids.decode(rows, PATH).orderBy("k").collect()] == ["", ""]


def test_other_kinds_of_model_are_refused():
    with pytest.raises((ValueError, RuntimeError, OSError)):
        piece_ids.Codec(P.path("byte_bpe_50k.json"))


def test_query_equals_the_library_on_every_document(spark, one):
    _, model = one
    got = {r.doc_id: r for r in queries.op11_piece_round_trip(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = model.encode(d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))
