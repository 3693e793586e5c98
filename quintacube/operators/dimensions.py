"""The five dimensions, each with its "all" member."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.functions.expressions import ALL, DATE_KEY
from quintacube.operators import staging
from quintacube.operators.surrogate import continued_ids, dense_ids

# The "all" member of every dimension, and the default texts.
ALL_MEMBERS = {
    "Dim_Tempo": (ALL, None, ALL, ALL, ALL),
    "Dim_Cliente": (ALL, ALL, "Todos os Clientes"),
    "Dim_Funcionario": (ALL, "-1", "Todos os Funcionários", "Total"),
    "Dim_Produto": (ALL, ALL, "Todos os Produtos", "Total", "Agregado de todos os produtos"),
    "Dim_Loja": (ALL, "Todas as Lojas", "Total", "TT"),
}
#: Business key and id of each dimension; they are the same where the source's key is kept.
KEY_AND_ID = {
    "Dim_Tempo": ("idData", "idData"),
    "Dim_Cliente": ("cpf", "idCliente"),
    "Dim_Funcionario": ("idFuncionario", "idFuncionario"),
    "Dim_Produto": ("codProdutoOrigem", "idProduto"),
    "Dim_Loja": ("idLoja", "idLoja"),
}
NO_JOB = "Cargo Não Definido"
NO_DETAIL = "Sem descrição detalhada"


def with_all_member(dim: DataFrame, name: str) -> DataFrame:
    """Add the "all" member as a literal row, which costs no job and drops out of filtered plans."""
    columns = [
        F.lit(value).cast(field.dataType).alias(field.name)
        for value, field in zip(ALL_MEMBERS[name], dim.schema.fields, strict=True)
    ]
    return dim.unionByName(dim.sparkSession.sql("SELECT 1 AS one").select(*columns))


def dim_date(stg_sales: DataFrame) -> DataFrame:
    """One row per day with sales; days are made distinct before the calendar columns are built."""
    days = stg_sales.selectExpr("CAST(tb010_012_data AS date) AS dataCompleta").distinct()
    return days.selectExpr(
        f"{DATE_KEY.format('dataCompleta')} AS idData",
        "dataCompleta",
        "year(dataCompleta) AS ano",
        "month(dataCompleta) AS mes",
        "dayofmonth(dataCompleta) AS dia",
    )


def dim_client(stg_clients: DataFrame, surrogate: bool = True) -> DataFrame:
    """Unique clients; on a repeated key the first name in text order stays."""
    unique = stg_clients.groupBy(F.col("tb010_cpf").alias("cpf")).agg(
        F.min("tb010_nome").alias("nomeCliente")
    )
    if surrogate:
        return dense_ids(unique, "cpf", "idCliente")
    return unique.selectExpr("cpf AS idCliente", "cpf", "nomeCliente")


def dim_employee(stg_employees: DataFrame, stg_jobs: DataFrame) -> DataFrame:
    return stg_employees.join(stg_jobs, "tb005_matricula", "left").selectExpr(
        "tb005_matricula AS idFuncionario",
        "tb005_cpf AS cpf",
        "tb005_nome_completo AS nomeFuncionario",
        f"coalesce(tb006_nome_cargo, '{NO_JOB}') AS cargo",
    )


def dim_product(
    stg_products: DataFrame, t: staging.Tables, surrogate: bool = True
) -> DataFrame:
    rows = staging.with_first_detail(stg_products, t).selectExpr(
        "tb012_cod_produto AS codProdutoOrigem",
        "tb012_descricao AS nomeProduto",
        "categoria",
        f"coalesce(descricao_detalhada, '{NO_DETAIL}') AS descricaoProduto",
    )
    if surrogate:
        return dense_ids(rows, "codProdutoOrigem", "idProduto")
    return rows.selectExpr("codProdutoOrigem AS idProduto", "*")


def dim_store(stg_stores: DataFrame) -> DataFrame:
    return stg_stores.selectExpr("tb004_cod_loja AS idLoja", "nome_loja AS nomeLoja", "cidade", "uf")


def build_dimension(
    name: str, t: staging.Tables, stg: Mapping[str, DataFrame], surrogate: bool = True
) -> DataFrame:
    """One dimension with its "all" member."""
    if name == "Dim_Tempo":
        rows = dim_date(stg["vendas"])
    elif name == "Dim_Cliente":
        rows = dim_client(stg["clientes"], surrogate)
    elif name == "Dim_Funcionario":
        rows = dim_employee(stg["funcionarios"], stg["cargos_mais_recentes"])
    elif name == "Dim_Produto":
        rows = dim_product(stg["produtos"], t, surrogate)
    elif name == "Dim_Loja":
        rows = dim_store(stg["lojas"])
    else:
        raise KeyError(name)
    return with_all_member(rows, name)


def build_dimensions(
    t: staging.Tables, stg: Mapping[str, DataFrame], surrogate: bool = True
) -> dict[str, DataFrame]:
    return {name: build_dimension(name, t, stg, surrogate) for name in ALL_MEMBERS}


def new_members(stored: DataFrame, name: str, t: staging.Tables, stg: Mapping[str, DataFrame]) -> DataFrame:
    """Members that a stored dimension lacks; known ones keep their ids and their first texts."""
    key, id_name = KEY_AND_ID[name]
    rows = build_dimension(name, t, stg, surrogate=False).where(f"{id_name} <> {ALL}")
    if key == id_name:
        return rows.join(stored.select(key), key, "left_anti").select(*stored.columns)
    return continued_ids(stored, rows.drop(id_name), key, id_name).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema.fields]
    )
