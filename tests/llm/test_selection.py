"""Quality classifier, quality rules, source mixing and sharding."""

import random
import re
import zlib
from collections import Counter

import helpers
import numpy as np
import pytest

from quintacube.llm import mixing, quality_mil, quality_rules, queries, sharding

SF = "/root/testdata/sf0.01"


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, marked = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            marked |= {i, i + 1, i + 2}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return [len(words), sum(map(len, words)), symbols, repeated, len(marked)]


def test_rule_statistics_equal_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é\n\t#|") for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    texts += [t for _, t, _ in helpers.ODD] + ["a\x0bb", "x y", "a b c a b c", "l\nl\nl"]
    got = quality_rules.statistics(texts)
    assert [row[:5].tolist() for row in got] == [brute_statistics(t) for t in texts]


def test_rules_judge_every_row_and_follow_the_labels(spark):
    out = queries.op9_quality_rules(spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    assert sorted(out.index) == sorted(docs.index)
    for i in list(docs.index)[::7]:
        assert out.loc[i, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]].tolist() == brute_statistics(docs.text[i])
    failed = (out.n_words < 50) | (100 * out.n_repeat_words > 50 * out.n_words)
    assert (failed == out.base_failed).all() and not (failed & out.kept).any()
    joined = out.join(labels)
    decided = joined[~joined.base_failed]
    assert decided[decided.quality == 1].kept.mean() > 0.97 and decided[decided.quality == 0].kept.mean() < 0.05


def test_all_labelled_rows_count_however_they_repeat(spark):
    """The counted table equals one row at a time, and is no larger for more partitions or copies."""
    rng = np.random.default_rng(3)
    stats = rng.integers(0, 40, (300, len(quality_rules.STATS)))
    stats[0, 2] = 10**6  # far more symbols than words
    rows = [(int(i % 200) if i % 50 else None, *map(int, r)) for i, r in enumerate(stats)]
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in quality_rules.STATS)
    marked = [(i, None if i % 9 == 0 else i % 2, 0) for i in range(150)] + [(7, 0, 0), (7, 1, 0), (None, 1, 0)]
    labels = spark.createDataFrame(marked, "doc_id long, quality int, toxic int")
    want = {}
    for row, steps in zip(rows, quality_rules.ratios(stats), strict=True):
        for i, quality, _ in marked:
            if row[0] is not None and i == row[0] and quality is not None:
                want.setdefault(tuple(steps.astype(int)), [0, 0])[quality != 1] += 1
    measured = spark.createDataFrame(rows, schema)
    for copies in (1, 3):
        many = measured if copies == 1 else measured.unionByName(measured).unionByName(measured).repartition(17)
        found = quality_rules.labelled_steps(many, labels).collect()
        assert {tuple(r)[:4]: list(r)[4:] for r in found} == {k: [n * copies for n in v] for k, v in want.items()}


def test_forest_paths_and_threshold_against_plain_walks():
    rng = np.random.default_rng(4)
    rows, good, bad = rng.integers(0, 6, (40, 4)).astype(float), rng.integers(0, 50, 40), rng.integers(0, 9, 40)
    forest = quality_rules.Forest(rows, good + bad, trees=20)

    def walk(t, row):
        node = 0
        while forest.feature[t, node] >= 0:
            node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.split[t, node])
        return forest.length[t, node]

    paths = forest.path(rows)
    assert np.allclose(paths, [sum(walk(t, r) for t in range(20)) / 20 for r in rows])
    at = quality_rules.calibrate(paths, good, bad)

    def wrong(limit):
        return good[paths <= limit].sum() + bad[paths > limit].sum()

    assert wrong(at) == min(wrong(p) for p in paths)


@pytest.mark.parametrize("extra", [False, True])
def test_rules_on_odd_rows_without_labels(spark, extra):
    docs = helpers.documents(spark, helpers.ODD, extra)
    labels = spark.createDataFrame([(5, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality_rules.judge(docs, labels).collect()
    assert len(rows) == len(helpers.ODD)
    assert all(r.kept == (not r.base_failed) for r in rows)
    assert quality_rules.judge(docs.where("false"), labels).collect() == []


def test_classifier_scores_held_out_documents(spark):
    rows = {r.doc_id: r for r in queries.op3_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(rows[r.doc_id].held_out for r in held)
    assert sum(rows[r.doc_id].predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_held_out_labels_and_other_columns_do_not_move_a_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("crc32(string(doc_id)) % 3 <> 1")
    one = quality_mil.learn(docs, labels, fit_docs=150)
    two = quality_mil.learn(docs.selectExpr("doc_id", "text", "'x' AS source", "'xx' AS lang"), labels, fit_docs=150)
    a, b = (quality_mil.score(docs, m).orderBy("doc_id").collect() for m in (one, two))
    assert [r.score for r in a] == [r.score for r in b]


@pytest.mark.parametrize("extra", [False, True])
def test_classifier_on_odd_rows(spark, extra):
    docs = helpers.documents(spark, helpers.ODD, extra)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_mil.score(docs, quality_mil.learn(docs, none)).collect()} == {0.5}
    both = spark.createDataFrame([(1, 0), (5, 1), (3, None), (None, 1)], "doc_id long, quality int")
    model = quality_mil.learn(docs, both)
    scored = quality_mil.score(docs, model).collect()
    assert len(scored) == len(helpers.ODD) and all(np.isfinite(r.score) for r in scored)
    assert quality_mil.score(docs.where("false"), model).count() == 0
    assert quality_mil.accepted(docs, model).columns == docs.columns


def brute_sainte_lague(votes, most, seats):
    got = [0] * len(votes)
    for _ in range(min(seats, sum(m for v, m in zip(votes, most, strict=True) if v > 0))):
        best = max((i for i in range(len(votes)) if got[i] < most[i]), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def test_apportionment_equals_seat_by_seat():
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randrange(1, 7)
        votes = [rng.choice([0, rng.uniform(0, 50), rng.uniform(0, 5)]) for _ in range(n)]
        most, seats = [rng.randrange(0, 30) for _ in range(n)], rng.randrange(0, 60)
        if not sum(votes):
            continue
        got = mixing.apportion(np.array(votes), np.array(most), seats)
        assert got.tolist() == brute_sainte_lague(votes, most, seats), (votes, most, seats)


def test_targets_fill_up_to_three_times_a_source():
    assert mixing.fill_targets([10, 1000, 90], [5, 2, 1]) == pytest.approx([30, 800, 270])
    assert sum(mixing.fill_targets([7, 5, 100, 3], [5, 2, 1, 5])) == pytest.approx(115)
    assert mixing.fill_targets([0, 0], [5, 2]) == [0, 0]


def check_mix(rows, sizes):
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        by_source.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), some in by_source.items():
        assert sum(r["size"] for r in some) % size == 0 if size else True
        assert abs(sum(r.taken for r in some) - target * max(1, sum(r["size"] for r in some) // max(size, 1))) <= max(40, 0.02 * target)


def test_mix_takes_about_each_target(spark):
    rows = queries.op4_source_mixing(spark, SF).collect()
    again = queries.op4_source_mixing(spark, SF).collect()
    assert sorted(rows) == sorted(again)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text)) for d in docs}
    assert {r.doc_id: r["size"] for r in rows} == size
    source = {d.doc_id: d.source for d in docs}
    taken, target = Counter(), {}
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 3 * r["size"]
    names = sorted(target, key=str.encode)
    sizes = [sum(size[i] for i in size if source[i] == s) for s in names]
    wanted = mixing.fill_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    assert [target[s] for s in names] == pytest.approx(wanted)
    assert all(abs(taken[s] / target[s] - 1) < 0.01 for s in names)


@pytest.mark.parametrize("extra", [False, True])
def test_mix_of_odd_rows(spark, extra):
    docs = helpers.documents(spark, helpers.ODD, extra)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(helpers.ODD)
    check_mix(rows, None)
    assert all(r.taken == 0 for r in rows if r.doc_id in (1, 2, 4))
    assert mixing.mix(docs.where("false")).collect() == []
    kept = mixing.mixed_documents(docs.where("doc_id IS NOT NULL AND doc_id <> 3"))
    assert kept.columns == docs.columns


def test_mixed_documents_repeat_whole_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taken = {r.doc_id: (r["size"], r.taken) for r in mixing.mix(docs).collect()}
    copies = Counter(r.doc_id for r in mixing.mixed_documents(docs).select("doc_id").collect())
    assert all(abs(copies[i] * s - t) <= s / 2 for i, (s, t) in taken.items() if s)


def brute_shards(sizes, limit, depth=0, prefix=""):
    """Split on one more bit while a bucket is too large; rows are (address, bytes)."""
    total = sum(b for _, b in sizes)
    if total <= limit or len(sizes) == 1:
        return {a: prefix for a, _ in sizes}
    out = {}
    for bit in "01":
        part = [(a, b) for a, b in sizes if a[depth] == bit]
        if part:
            out |= brute_shards(part, limit, depth + 1, prefix + bit)
    return out


@pytest.mark.parametrize("limit", [1, 3000, 50_000, 10_000_000])
def test_shards_equal_recursive_splitting(spark, limit):
    import hashlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    rows = sharding.shard_documents(docs, limit, keep=["doc_id"]).collect()
    address = {r.doc_id: f"{int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:8], 16):032b}" for r in rows}
    wanted = brute_shards([(address[r.doc_id], r.bytes) for r in rows], limit)
    assert {r.doc_id: r.shard for r in rows} == {i: wanted[a] for i, a in address.items()}
    assert all(r.depth == len(r.shard) and (r.shard_bytes <= limit or r.oversized) for r in rows)


@pytest.mark.parametrize("extra", [False, True])
def test_shards_of_odd_rows_and_a_hot_key(spark, extra, tmp_path):
    docs = helpers.documents(spark, helpers.ODD + [(3, "same row", "b")] * 200, extra)
    rows = sharding.shard_documents(docs, 100).collect()
    assert len(rows) == len(helpers.ODD) + 200
    total = Counter()
    for r in rows:
        total[r.shard] += r.bytes
    assert all(total[r.shard] == r.shard_bytes and (r.shard_bytes <= 100 or r.oversized) for r in rows)
    assert [r.doc_id for r in rows if r.oversized] == [5]
    assert sharding.shard_documents(docs.where("false"), 100).count() == 0
    sharding.write_shards(sharding.shard_documents(docs, 100), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_sharding_stays_out_of_python(spark):
    plan = sharding.shard_documents(spark.read.parquet(f"{SF}/documents.parquet"), 1 << 16)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rows_that_repeat_a_labelled_id_stay_within_the_bound_of_learning(spark, monkeypatch):
    from quintacube.llm import quality_mil

    seen = []
    learned = quality_mil.Model.learn
    monkeypatch.setattr(quality_mil.Model, "learn", lambda self, x, counts, y: seen.append(counts) or learned(self, x, counts, y))
    docs = spark.createDataFrame([(1, "good words " * k) for k in range(1, 60)] + [(2, "bad #$% " * 40_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    quality_mil.learn(docs, labels, fit_docs=20)
    assert len(seen[0]) == 20
    quality_mil.learn(docs.where("doc_id = 2"), labels)
    assert seen[1].tolist() == [80_000 // quality_mil.PASSAGE_WORDS]
