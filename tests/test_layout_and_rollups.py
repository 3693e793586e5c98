"""Rows along the curve, and roll-ups from the smallest stored ancestor."""

from fractions import Fraction
from itertools import combinations
from pathlib import Path

import pyarrow.parquet as pq
import pytest
import world
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.operators import cube, layout, rollup
from quintacube.plans import full_run as runs
from quintacube.plans import rollups
from quintacube.sources import versions
from quintacube.sources.tables import save_table

DAYS, CLIENTS = 1080, 120


def groups(spark):
    """Client-day rows over three years, and their totals by day."""
    day = "CAST((2021 + id div 360) * 10000 + (1 + id % 360 div 30) * 100 + 1 + id % 30 AS int) AS idData"
    days = spark.range(DAYS).selectExpr("id", day)
    both = days.crossJoin(spark.range(1, CLIENTS + 1).select(F.col("id").alias("idCliente")))
    rest = "-1L AS idFuncionario", "-1 AS idLoja", "-1L AS idProduto", "id AS quantidade", "1.5BD AS valor", "0.5BD AS lucro"
    one = both.selectExpr("7 AS gid", "idData", "idCliente", *rest)
    return one.unionByName(days.selectExpr("15 AS gid", "idData", "-1L AS idCliente", *rest)).orderBy(F.hash("idCliente", "idData"))


def overlapping(folder, column, low, high):
    """Files whose statistics do not rule out a range of a column, and the number of files."""
    files = sorted(Path(folder, "gid=7").glob("*.parquet"))
    def may_hold(path):
        meta = pq.ParquetFile(path).metadata
        i = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
        return any(s.min <= high and s.max >= low for s in stats)
    return sum(map(may_hold, files)), len(files)


def scanned(df):
    """Rows that the scan gave out, after what statistics have ruled out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    scan = plan
    while not scan.nodeName().startswith("Scan"):
        scan = scan.children().head()
    return scan.metrics().apply("numOutputRows").value()


def test_a_month_and_a_client_each_read_few_files(spark, tmp_path, monkeypatch):
    rows = cut(groups(spark))
    monkeypatch.setattr(layout, "FILE_BYTES", layout.size_in_bytes(rows) // 64)
    folder = str(tmp_path)
    save_table(layout.clustered(rows), folder, "gid")
    month, total = overlapping(folder, "idData", 20220301, 20220331)
    client, _ = overlapping(folder, "idCliente", 17, 17)
    # 64 files are strips of an eighth in both keys; a short range meets two of them, or a bit of a third.
    assert total >= 48 and month <= total / 3 and client <= total / 3
    stored = spark.read.parquet(folder)
    assert stored.count() == rows.count() and rows.exceptAll(stored.select(rows.columns)).isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for condition, n in (("idData BETWEEN 20220301 AND 20220331", 30 * CLIENTS), ("idCliente = 17", DAYS)):
            found = stored.where(f"gid = 7 AND {condition}")
            assert found.count() == n
            assert n <= scanned(found.select("quantidade")) <= DAYS * CLIENTS / 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_the_curve_keeps_every_kind_of_row(spark):
    fields = "gid int, idData int, idCliente bigint, idFuncionario bigint, idLoja int, idProduto bigint"
    for given in ([], [(31, -1, -1, -1, -1, -1)], [(0, 20240101, 5, 2**50, 3, -9), (0, 20240101, 5, 2**50, 3, -9), (15, 19991231, -1, -1, -1, -1)]):
        assert sorted(map(tuple, layout.clustered(spark.createDataFrame(given, fields)).collect())) == sorted(given)


# ------------------------------------------------------------------ roll-ups

CATEGORY = ["Alimentos", "Eletros", "Roupas"]
CITY = {1: ("Curitiba", "PR"), 2: ("São Paulo", "SP"), 3: ("São Paulo", "SP")}


def level_values(sale, level):
    """Columns of a level for a sale, or None if its member is unknown."""
    chain = next(c for c in rollup.CHAINS if level in c)
    key = world.key_of(sale, chain[0])
    if key is None:
        return None
    if level == "mes":
        return key // 10000, key // 100 % 100
    if level == "ano":
        return (key // 10000,)
    if level == "categoria":
        return (CATEGORY[key % 3],)
    return (key,)


def by_hand(levels, place, sales=world.SALES):
    sums = {}
    for s in sales:
        parts = [place(s, level) if level in ("cidade", "uf") else level_values(s, level) for level in levels]
        if None in parts:
            continue
        price = Fraction(s["unitario"])
        q, v, p = sums.get(sum(parts, ()), (0, Fraction(0), Fraction(0)))
        gain = (price - world.average_cost(s["produto"])) * s["quantidade"]
        sums[sum(parts, ())] = (q + s["quantidade"], v + price * s["quantidade"], p + gain)
    return {k: (q, world.round_half_up(v, 2), world.round_half_up(p, 2)) for k, (q, v, p) in sums.items()}


@pytest.fixture(scope="module")
def out(spark, shop, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("rollups"))
    runs.full_run(spark, shop, folder)
    return folder


def check(spark, out, levels):
    dw = runs.read_warehouse(spark, out)
    place = {r["idLoja"]: r for r in dw["Dim_Loja"].collect()}
    clients = {r["idCliente"]: r["cpf"] for r in dw["Dim_Cliente"].collect()}
    products = {r["idProduto"]: r["codProdutoOrigem"] for r in dw["Dim_Produto"].collect()}

    def of(s, level):
        store = world.key_of(s, "idLoja")
        return None if store is None else tuple(place[store][c] for c in rollup.ATTRIBUTES[level])

    found = {}
    for r in rollups.roll_up(spark, out, levels).collect():
        names = rollup.columns_of(rollup.view(levels))
        back = {"idCliente": clients, "idProduto": products}
        key = tuple(back[c][r[c]] if c in back else r[c] for c in names)
        assert key not in found
        found[key] = (r["quantidade"], r["valor"], r["lucro"])
    assert found == by_hand(rollup.view(levels), of), levels


WANTED = [(), ("ano",), ("mes",), ("categoria",), ("uf",), ("cidade", "mes"), ("uf", "ano", "categoria"), ("idCliente", "mes"), ("idFuncionario", "categoria")]


def test_roll_ups_equal_the_sales_before_and_after_storing_some(spark, shop, out):
    for levels in WANTED:
        check(spark, out, levels)
    chosen = rollups.store_rollups(spark, out, WANTED, 3)
    assert len(chosen) == 3
    for levels in [*WANTED, *chosen]:
        check(spark, out, levels)
    version = versions.current(spark, runs.warehouse_root(out))
    assert {rollups.rollup_name(v) for v in chosen} <= set(version.tables)
    files = rollups.roll_up(spark, out, chosen[0]).inputFiles()
    assert files and all(f"/{rollups.rollup_name(chosen[0])}/" in f for f in files)


def test_a_load_drops_stored_roll_ups_and_a_new_layout_keeps_them(spark, shop, tmp_path):
    out = str(tmp_path)
    sales = shop["tb010_012_vendas"]
    runs.full_run(spark, {**shop, "tb010_012_vendas": sales.where("tb010_012_cod_venda % 2 = 0")}, out)
    root = runs.warehouse_root(out)

    def derived():
        return [n for n in versions.current(spark, root).tables if n.startswith(runs.DERIVED)]

    rollups.store_rollups(spark, out, [("mes", "categoria")], 1)
    assert len(derived()) == 2
    rows = sorted(map(str, runs.read_warehouse(spark, out)[runs.FACT].collect()))
    runs.recluster_fact(spark, out)
    assert len(derived()) == 2 and sorted(map(str, runs.read_warehouse(spark, out)[runs.FACT].collect())) == rows
    runs.load_increment(spark, {**shop, "tb010_012_vendas": sales.where("tb010_012_cod_venda % 2 = 1")}, out)
    assert not derived()
    check(spark, out, ("mes", "categoria"))


def test_only_complete_keys_are_summed_away(spark, out):
    sizes, complete = rollups.stored_views(spark, out, versions.current(spark, runs.warehouse_root(out)))
    # Clients, stores and products have unknown members in the shop.
    assert complete == {"idData", "idFuncionario"}
    assert not rollup.can_answer(("idCliente", "idData"), ("mes",), complete)
    assert rollup.can_answer(("idData", "idProduto"), ("categoria",), complete)
    assert not rollup.can_answer(("ano",), ("mes",), complete) and not rollup.can_answer((), ("ano",), complete)
    for levels in rollup.lattice():
        able = [v for v in sizes if rollup.can_answer(v, levels, complete)]
        assert sizes[rollup.smallest(sizes, levels, complete)] == min(sizes[v] for v in able)
    with pytest.raises(LookupError):
        rollup.smallest({(): 1}, ("ano",), complete)
    for wrong in (("mes", "ano"), ("bairro",), ("uf", "uf")):
        with pytest.raises(ValueError, match="level"):
            rollup.view(wrong)


def test_the_choice_saves_what_it_should():
    every = set(cube.KEYS)
    stored = {v: 1 for v in rollup.lattice() if not v}
    stored |= {("idData", "idProduto"): 100_000, ("idData", "idLoja"): 9_000, ("idProduto",): 1_000}
    candidates = {("mes", "idProduto"): 12_000, ("mes", "categoria"): 300, ("ano", "categoria"): 60, ("mes", "uf"): 700, ("categoria",): 20}
    wanted = [*candidates, ("ano",), ("uf",), ("ano", "idProduto")]

    def cost(more):
        sizes = stored | {v: candidates[v] for v in more}
        return sum(sizes[rollup.smallest(sizes, w, every)] for w in wanted)

    for count in (1, 2, 3):
        best = min(cost(c) for c in combinations(candidates, count))
        found = cost(rollup.choose(stored, candidates, wanted, count, every))
        assert cost(()) - found >= 0.63 * (cost(()) - best)
        assert count > 1 or found == best
    assert len(rollup.choose(stored, candidates, wanted, 99, every)) <= len(candidates)
    assert rollup.choose(stored, {}, wanted, 3, every) == []
