"""The audit of filters, beside all orders played through document by document."""

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from quintacube.llm import filter_audit as fa
from quintacube.llm import queries

LABELS = "doc_id long, quality int, toxic int"


def fails(docs):
    """Failed filters of each row, by the contract."""
    out = []
    for doc_id, text, _ in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = ""
        bad += "A" * (len(w) < 200)
        bad += "B" * (100 * len(set(w)) < 50 * len(w))
        bad += "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t))
        bad += "D" * bool(re.search(r"[#$%&*|]", t))
        bad += "E" * any(d is not None and doc_id is not None and d < doc_id and (x or "") == t for d, x, _ in docs)
        out.append(bad)
    return out


def by_hand(docs, labels):
    """docs: (doc_id, text, lang); every order over every document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = [(lang or "", doc_id, bad) for (doc_id, _, lang), bad in zip(docs, fails(docs), strict=True)]
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[2]]
                left = [r for r in left if name not in r[2]]
                total[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in r[2] for r in mine) - len(gone), sum(r[2] == name for r in mine),
                    sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def run(spark, docs, labels, more=()):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    for name in more:
        frame = frame.withColumn(name, F.lit("clash"))
    found = fa.filter_audit(frame, spark.createDataFrame(labels, LABELS)).collect()
    keys = [(r.part, r.filter_order, r.step) for r in found]
    assert len(set(keys)) == len(keys)
    return {k: tuple(r[c] for c in fa.COUNTS) for k, r in zip(keys, found, strict=True)}


def corpus(seed, n):
    rng = random.Random(seed)
    texts = [None, "", "Aa#", helpers.prose(1, 250), helpers.prose(2, 250) + " %", "a b " * 150, "A B " * 150, "UP " + helpers.prose(3, 199)]
    docs = [(k, rng.choice(texts) if rng.random() < 0.7 else helpers.prose(k, rng.choice([10, 220])), rng.choice(["x", "y", None, ""])) for k in range(n)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, n, 2)]
    return docs, labels


def test_every_order_equals_brute_force(spark):
    docs, labels = corpus(1, 120)
    assert run(spark, docs, labels) == by_hand(docs, labels)


def test_odd_rows(spark):
    docs, labels = corpus(2, 40)
    docs += [(None, "same", "x"), (None, "same", "x"), (90, "same", None), (90, "same", "y"), (91, "same", "y"), (3, "twice", "x"), (3, "twice", "x")]
    docs += [(None, None, None), (92, helpers.prose(9, 30_000), "z")]
    labels += [(90, 1, None), (90, 0, 1), (90, 1, 1), (None, 1, 1), (12345, 1, 1), (91, None, 1)]
    clashing = ["mask", "part", "body", "n", "good", "bad", "first", "step", "quality", "toxic", "stay"]
    assert run(spark, docs, labels, clashing) == by_hand(docs, labels)


def test_empty_tables(spark):
    docs, labels = corpus(3, 20)
    assert run(spark, [], labels) == {}
    assert run(spark, docs, []) == by_hand(docs, [])


def test_a_text_in_a_third_of_all_rows(spark):
    docs = [(k, "hot text" if k % 3 == 0 else helpers.prose(k, 20), "x") for k in range(600)]
    found = run(spark, docs, [])
    assert found["x", "EABCD", 1][1] == 199 and found["x", "ABCDE", 5][3] == 0


def test_min_plus_product_against_its_definition():
    chosen = fa.orders()
    got = fa.removal_steps(chosen)
    assert chosen.shape == (120, 5) and got.shape == (32, 120)
    for mask in range(32):
        for order in range(120):
            steps = [k + 1 for k, f in enumerate(chosen[order]) if mask >> f & 1]
            assert got[mask, order] == min(steps, default=6)


def test_counts_add_up():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 100, 32)
    found = fa.audit(counts, counts // 2, counts // 3)
    assert len(found) == 600
    last = found[found["step"] == 5]
    assert set(last["kept"]) == {counts[0]}
    assert set(found.groupby("filter_order")["removed"].sum()) == {counts[1:].sum()}
    assert found.groupby("filter_order")["shapley"].sum().unique().tolist() == [120 * counts[1:].sum()]


@pytest.mark.parametrize("text", ["", "a\x0bb\x0cc", "a\xa0b a b", "É É É", "x#y", "A" * 3 + "a" * 97, "A" * 4 + "a" * 97, "\0 \0"])
def test_masks_of_texts(text):
    bad = fails([(1, text, None)])[0]
    assert fa.mask_of_text(text) == sum(fa.BIT[c] for c in bad)


def test_sql_on_odd_rows(spark, tmp_path):
    docs, labels = corpus(4, 60)
    docs += [(None, "same", "x"), (90, "same", None), (91, "same", "y"), (3, "twice", "x"), (3, "twice", "x")]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    import compare

    want = con.execute(fa.oracle_sql())
    got = queries.op13_filter_audit(spark, folder)
    assert compare.normal([tuple(r) for r in got.collect()], got.columns) == compare.normal(
        want.fetchall(), [d[0] for d in want.description]
    )
