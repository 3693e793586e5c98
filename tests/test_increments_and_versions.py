"""Loads that add to, change and delete from a stored warehouse, and the switch between its versions."""

from collections import Counter
from dataclasses import replace
from decimal import Decimal

import pytest
import world
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.operators import cube, increment, runlog, staging, surrogate
from quintacube.operators.dimensions import build_dimensions
from quintacube.plans import full_run as runs
from quintacube.sources import versions

SALES = "tb010_012_vendas"


def with_rows(shop, **tables):
    return {**shop, **tables}


def half(shop, condition):
    return shop[SALES].where(condition)


def state(spark, out):
    dw = runs.read_warehouse(spark, out)
    return world.natural(dw[runs.FACT], dw)


@pytest.fixture(scope="module")
def halves(spark, shop, tmp_path_factory):
    """A warehouse of the first half of the sales, and of the clients and purchases known by then."""
    out = str(tmp_path_factory.mktemp("halves"))
    early = with_rows(
        shop,
        **{
            SALES: half(shop, "tb010_012_cod_venda % 3 <> 0"),
            "tb010_clientes": shop["tb010_clientes"].where("tb010_cpf <> 103"),
            "tb012_017_compras": shop["tb012_017_compras"].where("tb012_cod_produto <> 4"),
        },
    )
    runs.full_run(spark, early, out)
    return out


def ids(spark, out, name, key, id_name):
    return {r[key]: r[id_name] for r in runs.read_warehouse(spark, out)[name].collect()}


def test_two_halves_equal_one_load_and_known_ids_stay(spark, shop, halves):
    before = {n: ids(spark, halves, n, k, i) for n, (k, i) in (("Dim_Cliente", ("cpf", "idCliente")), ("Dim_Produto", ("codProdutoOrigem", "idProduto")))}
    bound = runs.read_warehouse(spark, halves)
    first = world.natural(bound[runs.FACT], bound)
    # The client and the purchases that were missing are there now: old sales change with them.
    runs.load_increment(spark, with_rows(shop, **{SALES: half(shop, "tb010_012_cod_venda % 3 = 0")}), halves)
    assert state(spark, halves) == world.cube()
    assert world.natural(bound[runs.FACT], bound) == first  # a reader stays with its version
    for name, (key, id_name) in (("Dim_Cliente", ("cpf", "idCliente")), ("Dim_Produto", ("codProdutoOrigem", "idProduto"))):
        after = ids(spark, halves, name, key, id_name)
        assert before[name].items() <= after.items()
        assert sorted(after.values()) == [-1, *range(1, len(after))]
    assert ids(spark, halves, "Dim_Cliente", "cpf", "idCliente")[103] == len(before["Dim_Cliente"])
    log = runs.read_log(spark, halves).where(F.col("tipo_operacao") == runs.LOAD_INCREMENT).collect()
    assert [r["status"] for r in log] == [runlog.DONE]


def test_an_increment_without_changes_of_lookups_reads_no_old_sale(spark, shop, tmp_path, monkeypatch):
    out = str(tmp_path)
    runs.full_run(spark, with_rows(shop, **{SALES: half(shop, "tb010_012_cod_venda % 2 = 0")}), out)
    taken = []
    monkeypatch.setattr(increment, "regrained", lambda *a: taken.append(a))
    dims = {n: runs.read_warehouse(spark, out)[n].count() for n in ("Dim_Cliente", "Dim_Produto", "Dim_Loja")}
    runs.load_increment(spark, with_rows(shop, **{SALES: half(shop, "tb010_012_cod_venda % 2 = 1")}), out)
    assert not taken and state(spark, out) == world.cube()
    assert {n: runs.read_warehouse(spark, out)[n].count() for n in dims} == dims


@pytest.mark.parametrize(("load", "step"), [("load_increment", 1), ("load_increment", 2), ("load_increment", None), ("full_run", 9)])
def test_a_failure_at_any_step_leaves_the_version_before(spark, shop, halves, monkeypatch, load, step):
    """The step-th table that is written fails, or the switch itself."""
    now = state(spark, halves)
    number = versions.current(spark, runs.warehouse_root(halves)).number
    whole, calls = versions.write, []

    def failing(*args, **more):
        calls.append(args)
        if step is None or len(calls) == step:
            raise OSError("injected")
        return whole(*args, **more)

    monkeypatch.setattr(versions, "publish" if step is None else "write", failing)
    with pytest.raises(OSError, match="injected"):
        getattr(runs, load)(spark, with_rows(shop, **{SALES: half(shop, "tb010_012_cod_venda < 20")}), halves)
    assert versions.current(spark, runs.warehouse_root(halves)).number == number
    assert state(spark, halves) == now


def table(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k int")


def test_versions_list_what_belongs_to_them(spark, tmp_path):
    root = str(tmp_path / "a b")
    first = versions.publish(spark, root, versions.Version(), {"t": versions.write(table(spark, [1, 2]), root, "t")})
    second = versions.publish(spark, root, first, {"u": versions.write(table(spark, []), root, "u")})
    new = versions.write(table(spark, [3]), root, "t")
    third = versions.publish(spark, root, second, {"t": versions.replaced(spark, root, second, "t", [], new)})
    assert versions.current(spark, root) == third and third.number == 3

    def rows(version, name="t"):
        return sorted(r.k for r in versions.read(spark, root, version, name).collect())

    assert rows(first) == [1, 2] and rows(third) == [1, 2, 3] and rows(third, "u") == []
    with pytest.raises(versions.Superseded):
        versions.publish(spark, root, second, {})
    unlisted = versions.write(table(spark, [9]), root, "t")
    versions.expire(spark, root, keep=1)
    assert versions.current(spark, root) == third and rows(third) == [1, 2, 3]
    assert not (tmp_path / "a b" / "t" / unlisted.paths[0]).exists()
    assert len(list((tmp_path / "a b" / "_versions").glob("*.json"))) == 1


def test_deletes_rewrite_only_files_with_hits(spark, shop, tmp_path):
    out = str(tmp_path)
    runs.full_run(spark, shop, out)
    root = runs.warehouse_root(out)
    old = versions.current(spark, root)
    names = set(versions.files(versions.read(spark, root, old, runs.FACT), runs.FACT))
    gone = (F.col("gid") == 23) & (F.col("idCliente") == 1)
    wanted = sorted(map(str, runs.read_warehouse(spark, out)[runs.FACT].where(~gone).collect()))
    n = runs.delete_stored(spark, out, runs.FACT, gone)
    after = versions.current(spark, root)
    kept = set(versions.files(versions.read(spark, root, after, runs.FACT), runs.FACT))
    assert n == 1 and len(names - kept) == 1 and all("gid=23" in f for f in names ^ kept)
    assert sorted(map(str, runs.read_warehouse(spark, out)[runs.FACT].collect())) == wanted
    assert runs.delete_stored(spark, out, runs.FACT, F.col("idData") == 0) == 0
    assert versions.current(spark, root) == after
    stores = runs.read_warehouse(spark, out)["Dim_Loja"].count()
    assert runs.delete_stored(spark, out, "Dim_Loja", F.col("uf") == F.lit("TT")) == 1
    assert runs.read_warehouse(spark, out)["Dim_Loja"].count() == stores - 1


def test_an_increment_needs_a_warehouse(spark, shop, tmp_path):
    with pytest.raises(ValueError, match="full run"):
        runs.load_increment(spark, shop, str(tmp_path))


def test_ids_continue_over_many_partitions(spark):
    known = cut(surrogate.dense_ids(spark.range(0, 2000, 3).withColumnRenamed("id", "k").repartition(7), "k", "n"))
    more = surrogate.continued_ids(known, spark.range(3000).withColumnRenamed("id", "k").repartition(9), "k", "n")
    found = {r.k: r.n for r in known.unionByName(more).collect()}
    assert found == {k: i for i, k in enumerate([*range(0, 2000, 3), *(k for k in range(3000) if k >= 2000 or k % 3)], 1)}
    none = known.where("false")
    assert sorted(r.n for r in surrogate.continued_ids(none, known.select("k"), "k", "n").collect()) == list(range(1, 668))


def test_changed_lookups(spark):
    def lookup(rows):
        return spark.createDataFrame(rows, "k int, a int, b decimal(5,2)")

    old = lookup([(1, 1, Decimal(1)), (2, None, None), (3, 1, None), (4, None, Decimal(2)), (5, 5, None), (None, 1, None)])
    new = lookup([(1, 1, Decimal(1)), (3, None, None), (4, None, Decimal(3)), (6, None, None), (7, 7, None), (None, 1, None)])
    found = increment.changed(old, new, "k").collect()
    assert sorted(r.k for r in found if r.k is not None) == [3, 4, 5, 7]


def test_sums_stay_exact_over_many_increments(spark):
    schema = "gid int, " + ", ".join(f"{k} int" for k in cube.KEYS) + ", quantidade bigint, valor decimal(38,8), lucro decimal(38,8)"
    third = Decimal("0.00333333")
    delta = spark.createDataFrame([(31, -1, -1, -1, -1, -1, 1, third, -third)], schema)
    stored = delta.limit(0)
    for _ in range(3):
        stored = cut(increment.merged(stored, delta))
    row = cube.with_rounded(stored, cube.Measures()).first()
    assert (row.quantidade, row.valor, row.lucro, row.valor_exato) == (3, Decimal("0.01"), Decimal("-0.01"), Decimal("0.00999999"))
    assert increment.merged(stored, increment.negated(stored)).count() == 0


def test_rows_are_dealt_out_before_they_are_merged(spark):
    kinds = "gid int, idData int, idCliente int, idFuncionario int, idLoja int, idProduto int, quantidade bigint, valor decimal(38,8), lucro decimal(38,8)"
    stored = spark.createDataFrame([(0, 1, 1, 1, 1, 1, 2, Decimal(5), Decimal(1)), (0, 1, None, 1, 1, 1, 2, Decimal(5), Decimal(1))], kinds)
    delta = spark.createDataFrame([(0, 1, 1, 1, 1, 1, -2, Decimal(-5), Decimal(-1)), (0, 1, None, 1, 1, 1, 1, None, Decimal(2)), (0, 2, 1, 1, 1, 1, 1, Decimal(1), Decimal(1))], kinds)
    found = increment.merged(stored, delta)
    got = {(r["idData"], r["idCliente"]): (r["quantidade"], r["valor"], r["lucro"]) for r in found.collect()}
    assert got == {(1, None): (3, Decimal(5), Decimal(3)), (2, 1): (1, Decimal(1), Decimal(1))}
    below = found._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(gid")
    assert len(below) == 2 + below[1].count("== Initial Plan ==") and "HashAggregate" not in below[-1]


def exact(given):
    grain = cut(cube.sales_grain(given))
    return replace(given, measures=cube.exact_measures(grain, cube.Measures())), grain


@pytest.fixture(scope="module")
def parts_of_sales(shop):
    """Two parts of the sales, and a third that takes back some of the first part."""
    stg = staging.build_staging(shop)
    given = cube.cube_input(stg, build_dimensions(shop, stg))

    def of(condition, quantity="tb010_012_quantidade"):
        sales = stg["vendas"].where(condition).withColumn("tb010_012_quantidade", F.expr(quantity))
        return replace(given, sales=cube.cube_input({**stg, "vendas": sales}, build_dimensions(shop, stg)).sales)

    code = "tb010_012_cod_venda"
    return of(f"{code} % 3 <> 0"), of(f"{code} % 3 = 0"), of(f"{code} % 3 = 1", "-tb010_012_quantidade")


@pytest.mark.parametrize(("change", "parts"), [("employees of two stores", "2"), ("an unknown store, sales taken back", "30")])
def test_sales_are_added_as_they_are_summed(spark, parts_of_sales, change, parts):
    """The same as adding the new sales' whole cube, however many keys are heavy."""
    old, new, back = parts_of_sales
    if change == "employees of two stores":
        more = old.employees.where("idFuncionario % 2 = 0").withColumn("idLoja", F.lit(1).cast(old.employees.schema["idLoja"].dataType))
        old, new = (replace(x, employees=x.employees.unionByName(more).distinct()) for x in (old, new))
    else:
        old, new = (replace(x, stores=x.stores.where("idLoja <> 1")) for x in (old, back))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        old, old_grain = exact(old)
        new, new_grain = exact(new)

        def written(rows):
            return cube.unrounded(cut(cube.with_rounded(rows, cube.Measures()), partition_by="gid"))

        expected = increment.merged(written(cube.build_cube(old, old_grain)), cube.build_cube(new, new_grain))
        found = increment.merged(written(cube.summed_groupings(old, old_grain)), new, new_grain)
        assert found.columns == expected.columns and found.dtypes == expected.dtypes
        rows = found.collect()
        assert len(rows) > 500 and Counter(rows) == Counter(expected.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_summed_sales_are_not_dealt_out_a_second_time(spark, parts_of_sales, monkeypatch):
    monkeypatch.setattr(cube, "heavy_keys", lambda rows, keys, *more: {k: [] for k in keys})
    (old, old_grain), (new, new_grain) = (exact(x) for x in parts_of_sales[:2])
    stored = cut(cube.summed_groupings(old, old_grain), partition_by="gid")
    plan = increment.merged(stored, new, new_grain)._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning" in line and "REPARTITION" not in line]
    assert sent and not [line for line in sent if "gid#" in line and ("idCliente" in line or "idProduto" in line)]
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(dealt) == 2 and "idCliente" in dealt[0] and "idProduto" in dealt[1]
