"""Statistics per file, compaction of the log, and scans in ranges of equal size."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.operators import runlog, sketches
from quintacube.plans import full_run as runs
from quintacube.plans import statistics
from quintacube.sources import files, versions
from quintacube.sources.schemas import LOG_DDL
from quintacube.sources.tables import range_predicates

# ------------------------------------------------------------------ statistics


def test_merged_sketches_stay_within_their_bounds(spark):
    n = 200_000
    rows = spark.range(n).selectExpr(
        "CAST(id % 2 AS int) AS gid", "CAST(id % 37 AS string) AS arquivo", "id DIV 4 AS k",
        "CAST(CAST(id AS double) * id / 1000 AS decimal(20,2)) AS v", "CAST(NULL AS decimal(20,2)) AS vazio",
    )
    found = {r["coluna"]: r for r in sketches.merged(cut(sketches.file_statistics(rows, ["k", "v", "vazio"])), by=()).collect()}
    assert {c: (r["linhas"], r["nulos"]) for c, r in found.items()} == {"k": (n, 0), "v": (n, 0), "vazio": (n, n)}
    assert (found["k"]["menor"], found["k"]["maior"]) == (0, n // 4 - 1)
    assert abs(found["k"]["distintos"] / (n / 4) - 1) <= 0.05 and found["vazio"]["distintos"] == 0
    for q, value in zip((0.25, 0.5, 0.75), found["v"]["quantis"], strict=True):
        assert abs((value * 1000) ** 0.5 / n - q) <= 0.03
    assert found["vazio"]["quantis"] is None
    by_gid = sketches.merged(sketches.file_statistics(rows, ["k"])).collect()
    assert sorted((r["gid"], r["linhas"]) for r in by_gid) == [(0, n // 2), (1, n // 2)]
    assert sketches.merged(sketches.file_statistics(rows.limit(0), ["k"])).count() == 0


def plain(df):
    return sorted((r["gid"], r["coluna"], r["linhas"], r["nulos"], r["menor"], r["maior"], r["distintos"]) for r in df.collect())


def test_a_change_reads_only_new_files_for_statistics(spark, shop, tmp_path, monkeypatch):
    out = str(tmp_path)
    runs.full_run(spark, shop, out)
    root = runs.warehouse_root(out)
    before = set(versions.files(versions.read(spark, root, versions.current(spark, root), runs.FACT), runs.FACT))
    read, whole = [], statistics._computed
    monkeypatch.setattr(statistics, "_computed", lambda *a: read.extend(a[4]) or whole(*a))
    assert runs.delete_stored(spark, out, runs.FACT, (F.col("gid") == 23) & (F.col("idCliente") == 1)) == 1
    after = versions.current(spark, root)
    listed = set(versions.files(versions.read(spark, root, after, runs.FACT), runs.FACT))
    assert set(read) == listed - before and len(read) < len(listed) / 4
    read.clear()
    found = plain(runs.fact_statistics(spark, out))
    assert not read  # all from what is stored
    again = sketches.merged(whole(spark, root, after, runs.FACT, sorted(listed)))
    assert found == plain(again)
    fact = runs.read_warehouse(spark, out)[runs.FACT]
    assert {(g, n) for g, c, n, *_ in found if c == "valor"} == {(r["gid"], r["count"]) for r in fact.groupBy("gid").count().collect()}
    kept = {r["arquivo"] for r in versions.read(spark, root, after, runs.STATISTICS).collect()}
    assert kept == listed


# ------------------------------------------------------------------ log


def log_files(out):
    return list(Path(runs.log_path(out)).glob("*.parquet"))


def logged(spark, out, number):
    """A log of one file a state: every run has started, most have ended."""
    began = datetime(2024, 1, 1)
    rows = []
    for i in range(number // 2):
        start = began + timedelta(minutes=i)
        name = runlog.FULL_RUN if i % 5 == 0 else f"ETAPA_{i % 5}"
        rows.append((f"r{i}", start, name, runlog.STARTED, "x", None, None, None, start))
        end = runlog.FAILED if i % 7 == 0 else runlog.DONE
        rows.append((f"r{i}", start, name, end, "y", timedelta(seconds=i), None, None, start + timedelta(seconds=i)))
    one_each = spark.createDataFrame(rows, LOG_DDL).repartitionByRange(number, "id_log", "status")
    one_each.write.parquet(runs.log_path(out))


def answers(spark, out):
    log = runs.read_log(spark, out)
    results = [log, runlog.counts(log), runlog.recent(log, 10), runlog.full_runs(log), runlog.last_run_steps(log)]
    return [sorted(map(str, df.collect())) for df in results] + [runs.read_states(spark, out).count()]


def test_a_thousand_states_end_in_few_files(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    logged(spark, out, 1000)
    assert len(log_files(out)) > 500
    before = answers(spark, out)
    assert before[-1] == 1000
    # A crash after the rows are written and before they are listed: states are there twice, readers see one.
    with monkeypatch.context() as m:
        m.setattr(files.json, "dumps", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runs.compact_log(spark, out)
    assert answers(spark, out) == before
    many = len(log_files(out))
    assert runs.compact_log(spark, out) == many and len(log_files(out)) == many + 1
    assert answers(spark, out) == before
    # Someone appends while the old files wait; a later call gathers that state too and deletes what waited.
    runlog.append_state(spark, runs.log_path(out), "X", runlog.STARTED, "x", datetime(2020, 1, 1), "late")
    assert runs.compact_log(spark, out, timedelta(0)) == 0
    assert len(log_files(out)) <= 2
    assert runs.read_states(spark, out).count() == 1001
    log = runs.read_log(spark, out).where("id_log <> 'late'")
    assert sorted(map(str, log.collect())) == before[0]
    assert runs.compact_log(spark, out, timedelta(0)) == 0 and len(log_files(out)) == 1


def test_compaction_of_a_log_that_is_not_there(spark, tmp_path):
    assert runs.compact_log(spark, str(tmp_path)) == 0
    assert runs.read_log(spark, str(tmp_path)).count() == 0


# ------------------------------------------------------------------ scans


def ranges_of(rows, predicates):
    return rows.agg(*[F.count_if(F.expr(p)).alias(str(i)) for i, p in enumerate(predicates)]).first()


@pytest.mark.parametrize("key", [
    "CAST(pow(id, 2) / 1000 AS bigint)",  # dense below, sparse above
    "IF(id % 5 < 3, 700, id % 5000)",  # one value holds more than half
    "IF(id % 3 = 0, NULL, id)",
    "CAST(1000000 / (id + 1) AS bigint)",  # many ties
])
def test_ranges_of_a_skewed_key_hold_at_most_twice_the_mean(spark, tmp_path, key):
    spark.range(30_000).selectExpr(f"{key} AS k", "id AS n").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    predicates = range_predicates(rows, "k", 12, "n")
    assert 12 <= len(predicates) <= 20
    counts = ranges_of(rows, predicates)
    assert sum(counts) == 30_000 and max(counts) <= 2 * 30_000 / len(predicates)
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in predicates), F.lit(0))
    assert rows.where(hits != 1).isEmpty()


def test_ranges_of_odd_tables(spark):
    rows = spark.range(10).selectExpr("CAST(NULL AS bigint) AS k", "id AS n")
    for given, parts in ((rows, 4), (rows.limit(0), 4), (rows, 1)):
        assert sum(ranges_of(given, range_predicates(given, "k", parts, "n"))) == given.count()
    hot = spark.range(100).selectExpr("7L AS k", "id AS n")
    assert sum(ranges_of(hot, range_predicates(hot, "k", 4))) == 100
    assert max(ranges_of(hot, range_predicates(hot, "k", 4, "n"))) <= 50
    with pytest.raises(ValueError, match="partition"):
        range_predicates(rows, "k", 0)


def test_tables_written_on_the_way_are_compressed_beyond_the_default(spark):
    import pyarrow.parquet as pq

    rows = spark.range(20_000).selectExpr("id % 2 AS g", "id", "CAST(id AS decimal(38,8)) AS d", "CAST(id % 100 AS string) AS s")
    written = cut(rows, partition_by="g")
    files = [f.removeprefix("file:") for f in written.inputFiles()]
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    written = written.select(rows.columns)
    assert written.exceptAll(rows).isEmpty() and rows.exceptAll(written).isEmpty()
