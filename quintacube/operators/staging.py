"""Staging: the narrow copies of the source tables the warehouse is built from."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quintacube.functions.sizing import small_side

Tables = Mapping[str, DataFrame]


def sales(t: Tables) -> DataFrame:
    return t["tb010_012_vendas"].selectExpr(
        "tb010_012_cod_venda",
        "CAST(tb010_cpf AS bigint) AS tb010_cpf",
        "tb012_cod_produto",
        "tb005_matricula",
        "tb010_012_data",
        "tb010_012_quantidade",
        "tb010_012_valor_unitario",
    )


def purchases(t: Tables) -> DataFrame:
    return t["tb012_017_compras"].select("tb012_cod_produto", "tb012_017_valor_unitario")


def clients(t: Tables) -> DataFrame:
    return t["tb010_clientes"].selectExpr(
        "CAST(tb010_cpf AS bigint) AS tb010_cpf", "tb010_nome"
    )


def employees(t: Tables) -> DataFrame:
    return t["tb005_funcionarios"].select(
        "tb005_matricula", "tb005_cpf", "tb005_nome_completo", "tb004_cod_loja"
    )


def latest_per_key(df: DataFrame, key: str, *order) -> DataFrame:
    """First row of each key in the given order.

    Spark turns the rank filter into a group limit before the shuffle, so a map task sends at most
    one row per key and a hot key costs no more than any other.
    """
    ranked = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def latest_jobs(t: Tables, tie_break: str = "tb006_cod_cargo") -> DataFrame:
    """Most recent job of each employee; on equal promotion times the lowest tie-break wins.

    An aggregation picks the job, so that the optimizer knows there is one row per employee and
    leaves the whole branch out of queries that do not read the job. The few job names are looked
    up before; an employee whose latest job has no name is left out.
    """
    names = small_side(t["tb006_cargos"].selectExpr("tb006_cod_cargo", "tb006_nome_cargo", "true AS _known"))
    promoted = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', tb005_006_data_promocao)"
    newest_first = F.struct(F.expr(f"{promoted} IS NULL"), F.expr(f"-{promoted}"), F.col(tie_break))
    return (
        t["tb005_006_funcionarios_cargos"]
        .join(names, "tb006_cod_cargo", "left")
        .groupBy("tb005_matricula")
        .agg(F.min_by(F.struct("tb006_nome_cargo", "_known"), newest_first).alias("_job"))
        .where("_job._known")
        .select("tb005_matricula", "_job.tb006_nome_cargo")
    )


def products(t: Tables) -> DataFrame:
    return (
        t["tb012_produtos"]
        .join(small_side(t["tb013_categorias"]), "tb013_cod_categoria")
        .selectExpr("tb012_cod_produto", "tb012_descricao", "tb013_descricao AS categoria")
    )


def product_details(t: Tables) -> DataFrame:
    """One row per product and combination of its detail rows; the fan-out is kept."""
    food = t["tb014_prd_alimentos"].select("tb012_cod_produto", "tb014_detalhamento")
    appliance = t["tb015_prd_eletros"].select("tb012_cod_produto", "tb015_detalhamento")
    clothing = t["tb016_prd_vestuarios"].select("tb012_cod_produto", "tb016_detalhamento")
    return (
        t["tb012_produtos"]
        .select("tb012_cod_produto")
        .join(food, "tb012_cod_produto", "left")
        .join(appliance, "tb012_cod_produto", "left")
        .join(clothing, "tb012_cod_produto", "left")
        .select(
            "tb012_cod_produto",
            F.coalesce("tb014_detalhamento", "tb015_detalhamento", "tb016_detalhamento").alias(
                "descricao_detalhada"
            ),
        )
    )


def with_first_detail(rows: DataFrame, t: Tables) -> DataFrame:
    """Add one detail text per product: food before appliance before clothing, lowest detail id.

    Each detail table is cut to one row per product by an aggregation first. The joins cannot fan
    out then, and the optimizer drops them from queries that do not read the text.
    """
    sources = (
        ("tb014_prd_alimentos", "tb014_cod_prd_alimentos", "tb014_detalhamento"),
        ("tb015_prd_eletros", "tb015_cod_prd_eletro", "tb015_detalhamento"),
        ("tb016_prd_vestuarios", "tb016_cod_prd_vestuario", "tb016_detalhamento"),
    )
    for table, detail_id, text in sources:
        first = t[table].groupBy("tb012_cod_produto").agg(F.min_by(text, detail_id).alias(text))
        rows = rows.join(first, "tb012_cod_produto", "left")
    texts = [text for _, _, text in sources]
    return rows.withColumn("descricao_detalhada", F.coalesce(*texts)).drop(*texts)


def stores(t: Tables) -> DataFrame:
    """Store with city and state; a store without a known address is left out."""
    address = t["tb003_enderecos"].select(
        "tb003_cod_endereco", "tb002_cod_cidade", "tb001_sigla_uf"
    )
    city = t["tb002_cidades"].select("tb002_cod_cidade", "tb001_sigla_uf", "tb002_nome_cidade")
    state = t["tb001_uf"].select("tb001_sigla_uf")
    return (
        t["tb004_lojas"]
        .select("tb004_cod_loja", "tb003_cod_endereco")
        .join(address, "tb003_cod_endereco")
        .join(city, ["tb002_cod_cidade", "tb001_sigla_uf"])
        .join(state, "tb001_sigla_uf")
        .selectExpr(
            "tb004_cod_loja",
            "concat('Loja ', CAST(tb004_cod_loja AS string)) AS nome_loja",
            "tb002_nome_cidade AS cidade",
            "tb001_sigla_uf AS uf",
        )
    )


BUILDERS = {
    "vendas": sales,
    "compras": purchases,
    "clientes": clients,
    "funcionarios": employees,
    "cargos_mais_recentes": latest_jobs,
    "produtos": products,
    "produtos_detalhes": product_details,
    "lojas": stores,
}


def build_staging(t: Tables) -> dict[str, DataFrame]:
    return {name: build(t) for name, build in BUILDERS.items()}
