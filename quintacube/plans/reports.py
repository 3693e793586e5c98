"""Management reports over single groupings of the cube.

Each report takes the rows of its grouping (from `cube_set` or `cube_slice`) and the dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.functions.expressions import DATE_KEY
from quintacube.functions.sizing import small_side

Dims = Mapping[str, DataFrame]

# Texts that the reports show.
ONLINE_STORE = "Loja Virtual"
TOTAL_OF_CATEGORIES = "Total por Categoria"
TOTAL_OF_SALES = "Total de Vendas"

#: Dimension of each key of the fact, in the order of the keys.
DIMENSION_OF_KEY = ("Dim_Tempo", "Dim_Cliente", "Dim_Funcionario", "Dim_Loja", "Dim_Produto")

# Grouping each report reads.
GROUPING = {
    "q1_func_tempo": ("idData", "idFuncionario"),
    "q2_func_volume": ("idFuncionario",),
    "q3_func_loja": ("idFuncionario", "idLoja"),
    "q4_ultima_venda": ("idData", "idCliente"),
    "q5_cliente_periodo": ("idData", "idCliente"),
    "q6_categoria": ("idProduto",),
    "q6_total": (),
    "q7_total_vendas": (),
}


def _employees(dims: Dims) -> DataFrame:
    return small_side(dims["Dim_Funcionario"].select("idFuncionario", "nomeFuncionario"))


def by_employee_and_day(fact: DataFrame, dims: Dims) -> DataFrame:
    """Value per employee and day; only year and month of the day are shown."""
    return (
        fact.join(_employees(dims), "idFuncionario")
        .join(small_side(dims["Dim_Tempo"]), "idData")
        .select("ano", "mes", "nomeFuncionario", F.col("valor").alias("ValorTotalVendas"))
        .orderBy(*[F.asc_nulls_last(c) for c in ("ano", "mes", "nomeFuncionario")])
    )


def by_employee(fact: DataFrame, dims: Dims) -> DataFrame:
    return (
        fact.join(_employees(dims), "idFuncionario")
        .select(
            "nomeFuncionario",
            F.col("quantidade").alias("TotalProdutosVendidos"),
            F.col("valor").alias("ValorTotalVendas"),
        )
        .orderBy(F.desc_nulls_first("ValorTotalVendas"))
    )


def by_employee_and_store(fact: DataFrame, dims: Dims) -> DataFrame:
    return (
        fact.join(_employees(dims), "idFuncionario")
        .join(small_side(dims["Dim_Loja"]), "idLoja")
        .select(
            "nomeFuncionario",
            "nomeLoja",
            "cidade",
            "uf",
            F.col("quantidade").alias("NumeroDeAtendimentos"),
        )
        .orderBy(
            F.asc_nulls_last("nomeFuncionario"), F.desc_nulls_first("NumeroDeAtendimentos")
        )
    )


def last_sale_of_client(fact: DataFrame, dims: Dims) -> DataFrame:
    """Value of each client's latest day, found in one aggregation instead of a self-join."""
    last = fact.groupBy("idCliente").agg(
        F.max_by("valor", "idData").alias("valorTotal"), F.max("idData").alias("idData")
    )
    return (
        last.join(small_side(dims["Dim_Cliente"].select("idCliente", "nomeCliente")), "idCliente")
        .join(small_side(dims["Dim_Tempo"]), "idData")
        .select("nomeCliente", "valorTotal", "dataCompleta")
        .orderBy(F.asc_nulls_last("nomeCliente"))
    )


def by_client_in_period(
    fact: DataFrame, dims: Dims, first: str = "2023-01-01", last: str = "2025-03-31"
) -> DataFrame:
    """Value per client and day within a closed range of dates, over all stores.

    The range is put on the day key of the fact as well, which reaches the scan before any join.
    """
    start, end = f"DATE '{first}'", f"DATE '{last}'"
    days = dims["Dim_Tempo"].where(f"dataCompleta BETWEEN {start} AND {end}")
    return (
        fact.where(f"idData BETWEEN {DATE_KEY.format(start)} AND {DATE_KEY.format(end)}")
        .join(small_side(days), "idData")
        .join(small_side(dims["Dim_Cliente"].select("idCliente", "nomeCliente")), "idCliente")
        .select(
            "nomeCliente",
            F.col("valor").alias("ValorAcumulado"),
            F.lit(ONLINE_STORE).alias("tipo_loja"),
            "dataCompleta",
        )
        .orderBy(F.desc_nulls_first("ValorAcumulado"))
    )


def by_category(fact: DataFrame, dims: Dims) -> DataFrame:
    return (
        fact.join(small_side(dims["Dim_Produto"].select("idProduto", "categoria")), "idProduto")
        .groupBy("categoria")
        .agg(F.sum("quantidade").alias("QuantidadeTotalVendida"))
        .orderBy(F.desc_nulls_first("QuantidadeTotalVendida"))
    )


def total(fact: DataFrame, dims: Dims) -> DataFrame:
    return fact.select(
        F.lit(TOTAL_OF_CATEGORIES).alias("categoria"),
        F.col("quantidade").alias("QuantidadeTotalVendida"),
    )


def total_sales(fact: DataFrame, dims: Dims) -> DataFrame:
    return fact.select(
        F.lit(TOTAL_OF_SALES).alias("descricao"), F.col("quantidade").alias("Quantidade")
    )


REPORTS = {
    "q1_func_tempo": by_employee_and_day,
    "q2_func_volume": by_employee,
    "q3_func_loja": by_employee_and_store,
    "q4_ultima_venda": last_sale_of_client,
    "q5_cliente_periodo": by_client_in_period,
    "q6_categoria": by_category,
    "q6_total": total,
    "q7_total_vendas": total_sales,
}
