from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.operators import checks, cube, loads, runlog
from quintacube.plans import registry
from quintacube.sources.tables import jdbc_options

NOW = datetime(2024, 5, 1, 12, 0)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_ignore_keeps_the_target_and_the_first_new_row(spark):
    target = spark.createDataFrame([(1, "old"), (2, "two")], "k int, v string")
    source = spark.createDataFrame([(1, "new"), (3, "z"), (3, "a")], "k int, v string")
    assert rows(loads.insert_ignore(target, source, "k", [F.asc("v")])) == [
        (1, "old"), (2, "two"), (3, "a"),
    ]


def test_upsert_replaces_on_all_keys(spark):
    target = spark.createDataFrame([(1, 1, 10), (1, 2, 20)], "a int, b int, v int")
    source = spark.createDataFrame([(1, 2, 99), (2, 1, 5)], "a int, b int, v int")
    once = loads.upsert_fact(target, source, ["a", "b"])
    assert rows(once) == [(1, 1, 10), (1, 2, 99), (2, 1, 5)]
    assert rows(loads.upsert_fact(once, source, ["a", "b"])) == rows(once)


def test_delete_keeps_rows_with_an_unknown_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    assert [r[0] for r in loads.delete_where(df, F.col("v") > 3).collect()] == [1, None]


def log_of(spark, *states):
    rows_ = [
        (run, NOW - timedelta(minutes=ago), operation, status, None, None, None, None, NOW - timedelta(minutes=ago))
        for run, ago, operation, status in states
    ]
    from quintacube.sources.schemas import LOG_DDL

    return spark.createDataFrame(rows_, LOG_DDL)


def test_running_sees_only_recent_unfinished_runs(spark):
    def active(*states):
        return runlog.running(runlog.latest_state(log_of(spark, *states)), NOW).first()[0]

    assert active(("a", 10, "X", "INICIADO"))
    assert not active(("a", 10, "X", "INICIADO"), ("a", 10, "X", "SUCESSO"))
    assert not active(("a", 61, "X", "INICIADO"))
    assert not active(("a", 60, "X", "INICIADO"))  # strictly within the hour
    assert not active()


def test_purge_removes_only_old_starts(spark):
    log = log_of(
        spark, ("a", 3, "X", "INICIADO"), ("b", 2, "X", "INICIADO"), ("c", 9, "X", "ERRO")
    )
    left = runlog.purge_stuck(log, NOW)
    assert sorted(r["id_log"] for r in left.collect()) == ["b", "c"]


def test_last_run_steps_recent_counts_and_history(spark):
    log = log_of(
        spark,
        ("a", 50, "ETL_COMPLETO", "SUCESSO"),
        ("b", 30, "ETL_COMPLETO", "SUCESSO"),
        ("c", 20, "LIMPAR", "SUCESSO"),
        ("d", 10, "ETL_COMPLETO", "ERRO"),
    )
    steps = [r["tipo_operacao"] for r in runlog.last_run_steps(log).collect()]
    assert steps == ["ETL_COMPLETO", "LIMPAR", "ETL_COMPLETO"]
    assert [r["id_log"] for r in runlog.recent(log, 2).collect()] == ["d", "c"]
    assert rows(runlog.counts(log)) == [
        ("ETL_COMPLETO", "ERRO", 1), ("ETL_COMPLETO", "SUCESSO", 2), ("LIMPAR", "SUCESSO", 1),
    ]
    assert runlog.full_runs(log).count() == 3


def test_last_run_steps_without_a_successful_run(spark):
    assert runlog.last_run_steps(log_of(spark, ("d", 10, "ETL_COMPLETO", "ERRO"))).count() == 0


def test_status_summary_takes_the_greatest_status_at_the_latest_time(spark):
    log = log_of(spark, ("a", 5, "X", "SUCESSO"), ("b", 5, "Y", "ERRO"), ("c", 9, "Z", "ZZZ"))
    summary = runlog.status_summary(log, spark.range(7), spark.range(3), spark.range(2)).first()
    assert tuple(summary) == (NOW - timedelta(minutes=5), "SUCESSO", 7, 3, 2)


def test_unique_and_foreign_key_checks(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    assert rows(checks.unique_keys({"c": (child, ["k"]), "p": (parent, ["p"])})) == [
        ("c", 1), ("p", 0),
    ]
    assert rows(checks.foreign_keys({"r": (child, "k", parent, "p")})) == [("r", 2)]
    assert rows(checks.foreign_keys({"r": (parent, "p", parent, "p")})) == [("r", 0)]


def test_foreign_keys_of_several_columns(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "b"), (3, None)], "k int, s string")
    parent = spark.createDataFrame([(1, "a"), (2, "a"), (1, "b")], "k int, s string")
    assert rows(checks.foreign_keys({"r": (child, ["k", "s"], parent, ["k", "s"])})) == [("r", 2)]


def test_client_by_cpf(spark):
    clients = spark.createDataFrame([(1, 11, "a"), (2, 22, "b")], "idCliente int, cpf int, nomeCliente string")
    assert rows(checks.client_by_cpf(clients, 22)) == [(2, 22, "b")]
    assert rows(checks.client_by_cpf(clients, 33)) == []


def test_date_key_check_reports_both_sides(spark):
    fact = spark.createDataFrame([(-1,), (1,), (2,), (2,)], "idData int")
    dates = spark.createDataFrame([(-1,), (2,), (3,)], "idData int")
    assert rows(checks.date_keys(fact, dates)) == [(1, "fato"), (3, "dimensao")]


def test_sentinel_and_count_checks(spark):
    df = spark.createDataFrame([(-1, 2), (-1, -1), (3, None)], "a int, b int")
    assert rows(checks.sentinel_free({"t": (df, ["a", "b"])})) == [("t", "a", 2), ("t", "b", 1)]
    assert rows(checks.table_counts({"t": df, "u": df}, {"t": 3, "u": spark.range(2)})) == [
        ("t", 3, 3, True), ("u", 3, 2, False),
    ]
    assert rows(checks.slice_count(df, spark.range(5))) == [(3, 5)]


def test_column_stats(spark):
    df = spark.createDataFrame([(1, "b"), (3, None)], "n int, s string")
    assert rows(checks.column_stats({"t": df})) == [
        ("t", "n", 2, 0, "1", "3"), ("t", "s", 2, 1, "b", "b"),
    ]


def test_column_stats_hold_all_that_analyze_gathers(spark, tmp_path):
    """Checked against ANALYZE itself, whose distinct counts are estimates: exact for so few values."""
    df = spark.createDataFrame(
        [(1, "bé", Decimal("1.50")), (3, None, None), (3, "abcd", Decimal("2.00")), (None, "abcd", None)],
        "n int, s string, d decimal(20,2)",
    )
    found = {r["coluna"]: r for r in checks.column_stats({"t": df}, analyze=True).collect()}
    assert {c: tuple(r)[2:] for c, r in found.items()} == {
        "n": (4, 1, "1", "3", 2, 4, 4), "s": (4, 1, "abcd", "bé", 2, 4, 4), "d": (4, 2, "1.50", "2.00", 2, 16, 16),
    }
    spark.sql("DROP TABLE IF EXISTS analyzed")
    df.write.option("path", str(tmp_path / "t")).saveAsTable("analyzed")
    checks.analyze_tables(spark, ["analyzed"])
    for c, r in found.items():
        kept = {x["info_name"]: x["info_value"] for x in spark.sql(f"DESCRIBE EXTENDED analyzed {c}").collect()}
        assert (kept["distinct_count"], kept["num_nulls"], kept["avg_col_len"], kept["max_col_len"]) == (
            str(r["distintos"]), str(r["nulos"]), str(r["tamanho_medio"]), str(r["tamanho_maior"])
        )
    spark.sql("DROP TABLE analyzed")


def test_the_fact_is_analyzed_whole(spark):
    found = registry.run("table_stats", spark, "/root/testdata/sf0.001").where("tabela = 'Fato_Vendas'")
    fact = registry.Model(spark, "/root/testdata/sf0.001").fact
    expected = fact.agg(F.count("*"), *[F.count_distinct(c) for c in cube.COLUMNS]).first()
    stats = {r["coluna"]: r for r in found.collect()}
    assert [stats[c]["distintos"] for c in cube.COLUMNS] == list(expected)[1:]
    assert {r["linhas"] for r in stats.values()} == {expected[0]}


def test_jdbc_scan_is_split():
    options = jdbc_options("jdbc:x", "t", "id", 1, 100, 4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id", 5, 1, 4)


@pytest.mark.parametrize("mark", [None, 0])
def test_repeated_keys_of_several_columns_in_files(spark, monkeypatch, mark):
    keys = [(1, "a"), (1, "b"), (1, "b"), (None, "a"), (None, "a"), (None, "a"), ("2", None), (3, "c")]
    table = cut(spark.createDataFrame([(k and int(k), s) for k, s in keys], "k int, s string"))
    if mark is not None:  # all keys meet
        monkeypatch.setattr(checks, "_mark", lambda keys: F.lit(mark).cast("bigint"))
    seen = []
    monkeypatch.setattr(checks, "small_side", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    found = checks.unique_keys({"t": (table, ["k", "s"])})
    assert rows(found) == [("t", 2)]
    assert len(seen) == 1 and "hashpartitioning(k" not in seen[0]


def test_copies_of_rows_in_files_are_numbered_before_any_count(spark, monkeypatch):
    table = cut(spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 5), (None, 6)], "k int, s int"))
    copies = table.selectExpr("k", "inline(array(struct(s), struct(-1 AS s)))")
    seen = []
    monkeypatch.setattr(checks, "small_side", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    assert rows(checks.unique_keys({"t": (copies, ["k", "s"])})) == [("t", 2)]
    (plan,) = seen
    assert "hashpartitioning(k" not in plan and "HashAggregate" not in plan.split("Exchange hashpartitioning(_mark")[1]


def test_the_unique_check_reads_every_grouping_and_no_measure(spark, monkeypatch):
    written = []
    monkeypatch.setattr(registry, "cut", lambda df, **more: written.append(df.columns) or cut(df, **more))
    seen = {}
    monkeypatch.setattr(checks, "unique_keys", lambda tables: seen.update(tables))
    registry.check_unique(m := registry.Model(spark, "/root/testdata/sf0.001"))
    fact, keys = seen["Fato_Vendas"]
    assert written == [["gid", *cube.KEYS]] and keys == cube.KEYS
    counted = {tuple(r) for r in fact.groupBy("gid").count().collect()}
    assert counted == {tuple(r) for r in cube.build_cube(m.cube_input).groupBy("gid").count().collect()} and len(counted) == 32
