from datetime import date

import world
from pyspark.sql import functions as F

from quintacube.operators import cost, staging
from quintacube.operators.dimensions import build_dimensions
from quintacube.operators.surrogate import dense_ids


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_month_first_text_becomes_a_timestamp(shop):
    history = shop["tb005_006_funcionarios_cargos"]
    days = {str(r[0])[:10] for r in history.select("tb005_006_data_promocao").collect()}
    assert days == {"2015-03-04", "2016-07-08", "2015-05-06", "2016-06-09"}


def test_latest_job_breaks_ties_by_lowest_code(shop):
    # Employee 4 has only a job that is not in the job table.
    assert rows(staging.latest_jobs(shop), "tb005_matricula", "tb006_nome_cargo") == [
        (1, "Estoque"),
        (2, "Balcão"),
        (3, "Estoque"),
    ]


def test_latest_job_limits_rows_before_the_shuffle(shop):
    plan = staging.latest_jobs(shop)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan
    history = shop["tb005_006_funcionarios_cargos"]
    latest = staging.latest_per_key(history, "tb005_matricula", "tb006_cod_cargo")
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()


def test_store_needs_a_matching_address(shop):
    assert rows(staging.stores(shop), "tb004_cod_loja", "nome_loja", "cidade", "uf") == [
        (1, "Loja 1", "Curitiba", "PR"),
        (2, "Loja 2", "São Paulo", "SP"),
        (3, "Loja 3", "São Paulo", "SP"),
    ]


def test_product_details_keep_their_fan_out(shop):
    details = rows(staging.product_details(shop).na.fill("-"), "*")
    assert details[:5] == [(1, "arroz"), (1, "pão"), (2, "sal"), (3, "fogão"), (3, "rádio")]
    assert len(details) == 12 and details[5:7] == [(4, "blusa"), (5, "-")]


def test_dimensions(shop):
    dims = build_dimensions(shop, staging.build_staging(shop))
    assert rows(dims["Dim_Produto"], "idProduto", "codProdutoOrigem", "descricaoProduto")[:6] == [
        (-1, -1, "Agregado de todos os produtos"),
        (1, 1, "pão"),
        (2, 2, "sal"),
        (3, 3, "rádio"),
        (4, 4, "blusa"),
        (5, 5, "Sem descrição detalhada"),
    ]
    assert rows(dims["Dim_Funcionario"], "idFuncionario", "cargo")[:6] == [
        (-1, "Total"),
        (1, "Estoque"),
        (2, "Balcão"),
        (3, "Estoque"),
        (4, "Cargo Não Definido"),
        (5, "Cargo Não Definido"),
    ]
    clients = rows(dims["Dim_Cliente"], "idCliente", "cpf", "nomeCliente")
    assert clients[0] == (-1, -1, "Todos os Clientes")
    assert clients[1:] == [(i, c, f"Cliente {c}") for i, c in enumerate(world.CLIENTS, start=1)]
    assert rows(dims["Dim_Loja"], "idLoja")[0] == (-1,) and dims["Dim_Loja"].count() == 4
    days = {date(*s["dia"]) for s in world.SALES}
    tempo = [tuple(r) for r in dims["Dim_Tempo"].orderBy("idData").collect()]
    assert tempo[0] == (-1, None, -1, -1, -1)
    assert tempo[1:] == [
        (d.year * 10000 + d.month * 100 + d.day, d, d.year, d.month, d.day) for d in sorted(days)
    ]


def test_repeated_client_is_kept_once(spark):
    from quintacube.operators.dimensions import dim_client

    twice = spark.createDataFrame([(5, "b"), (5, "a"), (3, "c")], "tb010_cpf long, tb010_nome string")
    assert rows(dim_client(twice), "idCliente", "cpf", "nomeCliente") == [(1, 3, "c"), (2, 5, "a")]


def test_dense_ids_follow_the_key_over_many_partitions(spark):
    keys = spark.range(5000).select((F.col("id") * 7919 % 100003).alias("k")).distinct()
    numbered = dense_ids(keys, "k", "n").orderBy("k").collect()
    assert [r["n"] for r in numbered] == list(range(1, 5001))
    assert dense_ids(keys.limit(0), "k", "n").count() == 0


def test_average_cost_and_profit(shop):
    stg = staging.build_staging(shop)
    found = {r[0]: r[1] for r in cost.average_cost(stg["compras"]).collect()}
    products = {p for p, _ in world.PURCHASES}
    assert found == {p: world.round_half_up(world.average_cost(p), 8) for p in products}
    assert 7 not in found
    profit = cost.profit_per_sale(stg["vendas"], cost.average_cost(stg["compras"]))
    by_id = {r["tb010_012_cod_venda"]: r["lucro"] for r in profit.collect()}
    for s in world.SALES:
        exact = (s["unitario"] - world.round_half_up(world.average_cost(s["produto"]), 8)) * s[
            "quantidade"
        ]
        assert by_id[s["id"]] == exact
