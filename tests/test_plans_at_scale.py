"""Plans when lookups are too large to broadcast and one key holds most rows."""

import pytest
from pyspark.sql import functions as F

from quintacube.functions import sizing
from quintacube.operators import checks, cost, cube, staging
from quintacube.plans import registry

SF = "/root/testdata/sf0.001"
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(sizing.small_side, "__defaults__", (-1,))
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_sales(spark):
    """60 % of the sales on one product and one client."""
    return spark.range(60_000).selectExpr(
        "id AS tb010_012_cod_venda", "if(id % 5 < 3, 7L, id % 50) AS tb010_cpf",
        "if(id % 5 < 3, 7, CAST(id % 50 AS int)) AS tb012_cod_produto", "id % 4000 AS tb005_matricula",
        "TIMESTAMP_NTZ '2024-01-01' AS tb010_012_data", "CAST(id % 9 AS int) AS tb010_012_quantidade",
        "CAST(id % 31 AS decimal(12,2)) AS tb010_012_valor_unitario",
    ).repartition(8)


def purchases(spark):
    return spark.range(500).selectExpr("CAST(id % 50 AS int) AS tb012_cod_produto", "CAST(id AS decimal(12,2)) AS tb012_017_valor_unitario")


def test_profit_per_sale_splits_a_hot_product(spark, no_broadcast):
    sales = sizing.cut(skewed_sales(spark))
    found = cost.profit_per_sale(sales, cost.average_cost(purchases(spark)))
    text = plan(found)
    assert "skew=true" in text and "BroadcastHashJoin" not in text
    assert found.count() == 60_000


def input_of(spark):
    return cube.cube_input(
        {"vendas": sizing.cut(skewed_sales(spark)), "compras": purchases(spark), "funcionarios": spark.range(4000).selectExpr(
            "id AS tb005_matricula", "CAST(id % 3 AS int) AS tb004_cod_loja")},
        {
            "Dim_Cliente": spark.range(50).selectExpr("id AS idCliente", "id AS cpf").distinct(),
            "Dim_Loja": spark.range(3).selectExpr("CAST(id AS int) AS idLoja"),
            "Dim_Produto": spark.range(50).selectExpr("id AS idProduto", "CAST(id AS int) AS codProdutoOrigem"),
        },
    )


@pytest.mark.parametrize("keys", [("idFuncionario", "idProduto"), ("idCliente", "idFuncionario")])
def test_cube_set_splits_a_hot_lookup_key(spark, no_broadcast, keys):
    found = cube.cube_set(input_of(spark), keys)
    rows = sorted(map(str, found.collect()))
    assert "skew=true" in plan(found)
    for k, v in SETTINGS.items():
        spark.conf.unset(k)
    assert sorted(map(str, cube.cube_set(input_of(spark), keys).collect())) == rows


def test_few_valued_lookups_are_broadcast(spark):
    m = registry.Model(spark, SF)
    products = plan(staging.products(m.sources))
    assert "BroadcastHashJoin" in products and "hashpartitioning(tb013" not in products
    jobs = plan(staging.latest_jobs(m.sources, "event_id"))
    assert "BroadcastHashJoin" in jobs and "hashpartitioning(tb006" not in jobs


def test_latest_job_is_left_out_where_it_is_not_read(spark):
    dims = registry.Model(spark, SF).plain_dims
    text = plan(dims["Dim_Funcionario"].select("idFuncionario"))
    assert "events" not in text and "Join" not in text
    assert "Window" not in plan(registry.run("check_fk", spark, SF))


def test_lookups_are_measured_in_bytes_and_computed_ones_written(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert "broadcast" in sizing.small_side(rows)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in sizing.small_side(rows, 1)._jdf.queryExecution().logical().toString()
    written = sizing.cut(rows)
    assert 0 < sizing.size_in_bytes(written) < 100_000


@pytest.mark.parametrize("reference", ["fato_idCliente", "fato_idProduto", "vendas_produto", "endereco_cidade", "compras_produto"])
def test_an_orphan_is_found_in_each_kind_of_reference(spark, reference, monkeypatch):
    seen = {}
    monkeypatch.setattr(checks, "foreign_keys", lambda references: seen.update(references))
    registry.check_fk(registry.Model(spark, SF))
    monkeypatch.undo()
    for name, (child, key, parent, parent_key) in seen.items():
        if name == reference:
            columns = [key] if isinstance(key, str) else key
            kinds = dict(child.dtypes)
            bad = [F.lit("zz" if kinds[c] == "string" else 123456).cast(kinds[c]).alias(c) for c in columns]
            planted = child.select(*columns).unionByName(spark.range(3).select(*bad))
            assert [r["orfaos"] for r in checks.foreign_keys({name: (planted, key, parent, parent_key)}).collect()] == [
                3 + checks.foreign_keys({name: (child, key, parent, parent_key)}).first()["orfaos"]
            ]
            return
    raise AssertionError(sorted(seen))
