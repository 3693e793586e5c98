from datetime import date, timedelta

import pytest
import world
from pyspark.sql import functions as F

from quintacube.operators import cube, runlog
from quintacube.plans import full_run as runs
from quintacube.plans import reports


@pytest.fixture(scope="module")
def out(spark, shop, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    runs.full_run(spark, shop, folder, catalog="quintacube_test")
    return folder


@pytest.fixture(scope="module")
def dw(spark, out):
    return runs.read_warehouse(spark, out)


def report(dw, name, *args):
    rows = cube.cube_slice(dw[runs.FACT], reports.GROUPING[name])
    return [tuple(r) for r in reports.REPORTS[name](rows, dw, *args).collect()]


NAME = {e: f"{'ÁBÇ'[e % 3]} func {e}" for e in world.EMPLOYEES}
DAY = {world.key_of(s, "idData"): date(*s["dia"]) for s in world.SALES}


def test_stored_cube_equals_brute_force(dw):
    assert world.natural(dw[runs.FACT], dw) == world.cube()


def test_slice_reads_one_folder(dw):
    rows = cube.cube_slice(dw[runs.FACT], ("idData", "idFuncionario"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "gid" in partition_filters and "= 11" in partition_filters
    files = {r[0] for r in rows.select(F.input_file_name()).collect()}
    assert files and all("gid=11" in f for f in files)


def test_by_employee_and_day(dw):
    expected = sorted(
        (DAY[k[0]].year, DAY[k[0]].month, NAME[k[2]], m[1])
        for k, m in world.grouping(("idData", "idFuncionario")).items()
    )
    found = report(dw, "q1_func_tempo")
    assert sorted(found) == expected
    assert [r[:3] for r in found] == sorted(r[:3] for r in found)


def test_by_employee(dw):
    found = report(dw, "q2_func_volume")
    expected = {(NAME[k[2]], m[0], m[1]) for k, m in world.grouping(("idFuncionario",)).items()}
    assert set(found) == expected
    assert [r[2] for r in found] == sorted((r[2] for r in found), reverse=True)


def test_by_employee_and_store(dw):
    found = report(dw, "q3_func_loja")
    assert {(r[0], r[1], r[4]) for r in found} == {
        (NAME[k[2]], f"Loja {k[3]}", m[0])
        for k, m in world.grouping(("idFuncionario", "idLoja")).items()
    }
    assert [(r[0], -r[4]) for r in found] == sorted((r[0], -r[4]) for r in found)


def test_last_sale_of_client(dw):
    rows = world.grouping(("idData", "idCliente"))
    last = {}
    for k, m in rows.items():
        last[k[1]] = max(last.get(k[1], (0, None)), (k[0], m[1]))
    assert report(dw, "q4_ultima_venda") == sorted(
        (f"Cliente {c}", value, DAY[day]) for c, (day, value) in last.items()
    )


def test_by_client_in_period_includes_both_ends(dw):
    days = sorted(DAY.values())
    first, last = days[1], days[-2]
    found = report(dw, "q5_cliente_periodo", str(first), str(last))
    assert {(r[0], r[1], r[3]) for r in found} == {
        (f"Cliente {k[1]}", m[1], DAY[k[0]])
        for k, m in world.grouping(("idData", "idCliente")).items()
        if first <= DAY[k[0]] <= last
    }
    assert {r[3] for r in found} >= {first, last} and {r[2] for r in found} == {"Loja Virtual"}
    assert [r[1] for r in found] == sorted((r[1] for r in found), reverse=True)


def test_by_category_and_totals(dw):
    names = ["Alimentos", "Eletros", "Roupas"]
    sums = dict.fromkeys(names, 0)
    for k, m in world.grouping(("idProduto",)).items():
        sums[names[k[4] % 3]] += m[0]
    assert report(dw, "q6_categoria") == sorted(sums.items(), key=lambda r: -r[1])
    total = sum(s["quantidade"] for s in world.SALES)
    assert report(dw, "q6_total") == [("Total por Categoria", total)]
    assert report(dw, "q7_total_vendas") == [("Total de Vendas", total)]


STEPS = (
    runlog.FULL_RUN, runs.CLEAR_STAGING, runs.LOAD_STAGING, runs.CLEAR_WAREHOUSE, runs.LOAD_DIMENSIONS,
    runs.LOAD_FACT, runs.REFRESH_STATISTICS,
)


def test_last_run_lists_every_step_in_order(spark, out):
    steps = runlog.last_run_steps(runs.read_log(spark, out)).collect()
    assert [r["tipo_operacao"] for r in steps] == list(STEPS)
    assert all(r["duracao"] > timedelta(0) for r in steps)
    assert not runlog.running(runs.read_log(spark, out), runs._now()).first()[0]
    assert sorted(tuple(r) for r in runlog.counts(runs.read_log(spark, out)).collect()) == sorted(
        (step, "SUCESSO", 1) for step in STEPS
    )
    assert runs.read_states(spark, out).count() == 2 * len(STEPS)


def test_log_and_status_after_a_run(spark, out, dw):
    log = runs.read_log(spark, out)
    states = {r["tipo_operacao"]: r["status"] for r in log.collect()}
    assert states == dict.fromkeys(STEPS, "SUCESSO")
    assert all(r["duracao"].total_seconds() > 0 for r in log.collect())
    status = runs.run_status(spark, out).first()
    assert status["status"] == "SUCESSO"
    assert status["total_vendas"] == len(world.cube())
    assert status["total_clientes"] == len(world.CLIENTS) + 1
    assert status["total_produtos"] == len(world.PRODUCTS) + 1


def test_statistics_are_in_the_catalog(spark, out):
    described = spark.sql("DESCRIBE EXTENDED quintacube_test.Fato_Vendas").collect()
    assert any(
        r[0] == "Statistics" and f"{len(world.cube())} rows" in r[1] for r in described
    )


def test_second_run_gives_the_same_rows(spark, shop, out):
    runs.full_run(spark, shop, out)
    again = runs.read_warehouse(spark, out)
    assert world.natural(again[runs.FACT], again) == world.cube()


def test_failure_is_logged_and_raised(spark, shop, tmp_path):
    broken = dict(shop)
    broken["tb010_012_vendas"] = shop["tb010_012_vendas"].selectExpr(
        "* EXCEPT (tb010_012_quantidade)",
        "CAST(raise_error('broken source') AS int) AS tb010_012_quantidade",
    )
    with pytest.raises(Exception, match="broken source"):
        runs.full_run(spark, broken, str(tmp_path))
    log = runs.read_log(spark, str(tmp_path)).collect()
    states = {r["tipo_operacao"]: r["status"] for r in log}
    assert states == {runlog.FULL_RUN: "ERRO", runs.CLEAR_STAGING: "SUCESSO", runs.LOAD_STAGING: "ERRO"}
    assert all(r["erro_detalhado"] for r in log if r["status"] == "ERRO")


def test_a_long_error_is_kept_whole_and_the_warehouse_stays(spark, shop, out, tmp_path):
    folder = str(tmp_path)
    runs.full_run(spark, shop, folder)
    text = "x" * 5000
    broken = dict(shop)
    broken["tb012_produtos"] = shop["tb012_produtos"].selectExpr(
        "* EXCEPT (tb012_descricao)", f"CAST(raise_error('{text}') AS string) AS tb012_descricao"
    )
    with pytest.raises(Exception, match="xxxx"):
        runs.full_run(spark, broken, folder)
    failed = [r for r in runs.read_log(spark, folder).collect() if r["status"] == "ERRO"]
    assert failed and all(text in r["mensagem"] for r in failed)
    dw = runs.read_warehouse(spark, folder)
    assert world.natural(dw[runs.FACT], dw) == world.cube()


def test_purge_of_the_stored_log_lets_the_next_run_start(spark, shop, tmp_path):
    folder = str(tmp_path)
    began = runs._now() - timedelta(minutes=10)
    runlog.append_state(spark, runs.log_path(folder), "X", runlog.STARTED, "x", began)
    done = runlog.append_state(spark, runs.log_path(folder), "Y", runlog.STARTED, "y", began)
    runlog.append_state(spark, runs.log_path(folder), "Y", runlog.DONE, "y", began, done, timedelta(minutes=1))
    with pytest.raises(runs.AlreadyRunning):
        runs.full_run(spark, shop, folder)
    runs.purge_log(spark, folder)
    assert [(r["tipo_operacao"], r["status"]) for r in runs.read_log(spark, folder).collect()] == [("Y", "SUCESSO")]
    runs.full_run(spark, shop, folder)


def test_upsert_of_the_stored_fact(spark, out, shop, tmp_path):
    folder = str(tmp_path)
    runs.full_run(spark, shop, folder)
    before = runs.read_warehouse(spark, folder)[runs.FACT]
    total = cube.cube_slice(before, ()).first()
    wanted = sorted(map(str, before.where("gid <> 31").collect()))
    delta = before.where("gid = 31").withColumn("quantidade", F.col("quantidade") + 5)
    delta = delta.unionByName(before.where("gid = 23 AND idCliente > 0").limit(1).withColumn("idCliente", F.lit(-7).cast("bigint")))
    from quintacube.functions.sizing import cut

    delta = cut(delta)
    runs.upsert_stored_fact(spark, folder, delta)
    after = runs.read_warehouse(spark, folder)[runs.FACT]
    assert cube.cube_slice(after, ()).first()["quantidade"] == total["quantidade"] + 5
    rest = sorted(map(str, after.where("gid <> 31 AND idCliente <> -7").select(*before.columns).collect()))
    assert rest == wanted and after.where("idCliente = -7").count() == 1


def test_no_temporary_table_is_left_after_a_run(spark, shop, tmp_path):
    from pathlib import Path

    from quintacube.session import ensure_checkpoint_dir

    tables = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "tables"
    before = set(tables.iterdir()) if tables.exists() else set()
    runs.full_run(spark, shop, str(tmp_path))
    assert (set(tables.iterdir()) if tables.exists() else set()) <= before


def test_a_live_run_blocks_the_next(spark, shop, tmp_path):
    out = str(tmp_path)
    runlog.append_state(
        spark, runs.log_path(out), runlog.FULL_RUN, runlog.STARTED, "x", runs._now()
    )
    with pytest.raises(runs.AlreadyRunning):
        runs.full_run(spark, shop, out)
