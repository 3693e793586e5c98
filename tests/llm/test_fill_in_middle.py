"""Cuts by an indexable skip list, forms, and exact rebuilding."""

import hashlib
import random

import duckdb
import helpers
import pytest
from pyspark.sql import functions as F

from quintacube.llm import fill_in_middle as fim
from quintacube.llm import queries

TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "one\n", "a\nb", "a\n\nb\n", "x <P> y\nz", "a<S>\nb", "a\n<M>", "<\nP>\n<", "a<\nS>b\n<P",
    "é日😀\n\r\nb\x0bc\x85d e\n", "\n" * 100, "tail\n" * 500 + "end",
]


def by_hand(doc_id, text, seed=7, rate=100, spm=50):
    """The contract, with plain slices of the list of lines."""
    import re

    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:z]), "".join(lines[z:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 63, 64, 65, 511, 512, 513, 5000])
def test_every_rank_of_a_skip_list(n):
    rng = random.Random(n)
    widths = [rng.randrange(0, 50) for _ in range(n)]
    found = fim.SkipList(widths)
    assert len(found) == n
    at = 0
    for rank in range(n):
        assert found.offset(rank) == at
        at += widths[rank]
    assert found.offset(n) == at
    for lane, links in enumerate(found.lanes):
        assert len(links) == n // fim.FAN**lane
    for wrong in (-1, n + 1):
        with pytest.raises(IndexError):
            found.offset(wrong)


def test_a_descent_is_short():
    class Counted(list):
        steps = 0

        def __getitem__(self, k):
            Counted.steps += 1
            return super().__getitem__(k)

    found = fim.SkipList([1] * 100_000)
    found.lanes = [Counted(lane) for lane in found.lanes]
    assert found.offset(99_999) == 99_999
    assert Counted.steps <= fim.FAN * len(found.lanes)


def test_results_equal_plain_slices_and_go_back():
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab\n<SPM>é") for _ in range(rng.randrange(80))) for _ in range(2000)]
    seen = set()
    for k, text in enumerate(texts):
        for doc_id in (k, -k, None):
            got = fim.transform(doc_id, text or "")
            assert got == by_hand(doc_id, text or "")
            assert fim.restore(got[-1], got[1]) == (text or "")
            seen.add(got[1])
    assert seen == {"plain", "psm", "spm"}


def test_rates():
    texts = [helpers.prose(k, 5) + "\n" + helpers.prose(k + 1, 5) for k in range(2000)]
    forms = [fim.transform(k, t, rate=30, spm=20)[1] for k, t in enumerate(texts)]
    assert 500 < len(forms) - forms.count("plain") < 700 and 80 < forms.count("spm") < 160
    assert {fim.transform(k, t, rate=0)[1] for k, t in enumerate(texts)} == {"plain"}


def test_a_wrong_form_is_refused():
    with pytest.raises(ValueError):
        fim.restore("<P>a<S>b<M>c", "spm")


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, extra):
    docs = helpers.documents(spark, helpers.ODD, extra)
    if extra:
        docs = docs.withColumn("output", F.lit(1)).withColumn("form", F.lit("x")).withColumn("restored", F.lit(2.0))
    rows = fim.restored(fim.fill_in_middle(docs)).collect()
    want = [(i, *by_hand(i, t or ""), t or "") for i, t, _ in helpers.ODD]
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want))
    assert fim.restored(fim.fill_in_middle(docs.where("false"))).count() == 0


def test_long_texts_come_in_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(fim, "BATCH_CHARS", 100)
    texts = [(k, helpers.prose(k, k) + "\n" + helpers.prose(k, 2)) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.doc_id: r.restored for r in fim.restored(fim.fill_in_middle(docs)).collect()} == dict(texts)


def test_sql_on_odd_texts(spark, tmp_path):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS * 9)] + [(None, "a\nb\nc")], "doc_id long, text string")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    import compare

    want = con.execute(fim.oracle_sql())
    got = queries.op12_fill_in_middle(spark, folder)
    assert compare.normal([tuple(r) for r in got.collect()], got.columns) == compare.normal(
        want.fetchall(), [d[0] for d in want.description]
    )
