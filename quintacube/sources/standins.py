"""Source tables of the retail model, derived from order-management Parquet tables.

Line items that were not returned stand for sales, first lines that were for purchases, suppliers
for employees, nations for stores and the event stream for job histories and run logs.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the input tables. Declaring them spares a schema scan per table.
INPUT_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

# The event type that stands for a full run.
FULL_RUN = "purchase"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(INPUT_DDL[table]).parquet(f"{sf_dir}/{table}.parquet")


def sold_lines(line: DataFrame, orders: DataFrame) -> DataFrame:
    sold = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return sold.selectExpr(
        "l_orderkey * 10 + l_linenumber AS tb010_012_cod_venda",
        "o_custkey AS tb010_cpf",
        "l_partkey AS tb012_cod_produto",
        "l_suppkey AS tb005_matricula",
        "o_orderdate AS tb010_012_data",
        "CAST(l_quantity AS int) AS tb010_012_quantidade",
        "CAST(l_extendedprice AS decimal(12,2)) AS tb010_012_valor_unitario",
    )


class RetailTables(Mapping[str, DataFrame]):
    """The source tables of the retail model; each is built when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._builders = {
            "tb001_uf": self._states,
            "tb002_cidades": self._cities,
            "tb003_enderecos": self._addresses,
            "tb004_lojas": self._stores,
            "tb005_funcionarios": self._employees,
            "tb005_006_funcionarios_cargos": self._job_history,
            "tb006_cargos": self._jobs,
            "tb010_clientes": self._clients,
            "tb010_012_vendas": self._sales,
            "tb012_017_compras": self._purchases,
            "tb012_produtos": self._products,
            "tb013_categorias": self._categories,
            "tb014_prd_alimentos": self._food,
            "tb015_prd_eletros": self._appliances,
            "tb016_prd_vestuarios": self._clothing,
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def _read(self, table: str) -> DataFrame:
        return read(self._spark, self._sf_dir, table)

    def _nations(self) -> DataFrame:
        return self._read("nation").join(
            self._read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    def _states(self) -> DataFrame:
        return self._read("region").selectExpr(
            "r_name AS tb001_sigla_uf", "r_name AS tb001_nome_estado"
        )

    def _cities(self) -> DataFrame:
        return self._nations().selectExpr(
            "n_nationkey AS tb002_cod_cidade",
            "r_name AS tb001_sigla_uf",
            "n_name AS tb002_nome_cidade",
        )

    def _addresses(self) -> DataFrame:
        return self._nations().selectExpr(
            "n_nationkey AS tb003_cod_endereco",
            "r_name AS tb001_sigla_uf",
            "n_nationkey AS tb002_cod_cidade",
        )

    def _stores(self) -> DataFrame:
        return self._read("nation").selectExpr(
            "n_nationkey AS tb004_cod_loja",
            "n_nationkey AS tb003_cod_endereco",
        )

    def _employees(self) -> DataFrame:
        return self._read("supplier").selectExpr(
            "s_suppkey AS tb005_matricula",
            "s_nationkey AS tb004_cod_loja",
            "s_name AS tb005_nome_completo",
            "CAST(s_suppkey AS string) AS tb005_cpf",
        )

    def _job_history(self) -> DataFrame:
        return self._read("events").selectExpr(
            "user_id AS tb005_matricula",
            "event_type AS tb006_cod_cargo",
            "ts AS tb005_006_data_promocao",
            "event_id",
        )

    def _jobs(self) -> DataFrame:
        names = self._read("events").selectExpr("event_type AS tb006_cod_cargo")
        return names.distinct().selectExpr("tb006_cod_cargo", "tb006_cod_cargo AS tb006_nome_cargo")

    def _clients(self) -> DataFrame:
        return self._read("customer").selectExpr(
            "c_custkey AS tb010_cpf", "c_name AS tb010_nome"
        )

    def _sales(self) -> DataFrame:
        kept = self._read("lineitem").where("l_returnflag <> 'R'")
        return sold_lines(kept, self._read("orders"))

    def _purchases(self) -> DataFrame:
        bought = self._read("lineitem").where("l_returnflag = 'R' AND l_linenumber = 1")
        return bought.selectExpr(
            "l_partkey AS tb012_cod_produto",
            "CAST(l_extendedprice AS decimal(12,2)) AS tb012_017_valor_unitario",
        )

    def _products(self) -> DataFrame:
        return self._read("part").selectExpr(
            "p_partkey AS tb012_cod_produto",
            "p_brand AS tb013_cod_categoria",
            "p_name AS tb012_descricao",
        )

    def _categories(self) -> DataFrame:
        codes = self._read("part").selectExpr("p_brand AS tb013_cod_categoria")
        return codes.distinct().selectExpr("tb013_cod_categoria", "tb013_cod_categoria AS tb013_descricao")

    def _details(self, condition: str, detail_id: str, detail: str, source: str) -> DataFrame:
        rows = self._read("part").where(condition)
        return rows.selectExpr(
            f"p_partkey AS {detail_id}",
            "p_partkey AS tb012_cod_produto",
            f"{source} AS {detail}",
        )

    def _food(self) -> DataFrame:
        return self._details(
            "p_size <= 20", "tb014_cod_prd_alimentos", "tb014_detalhamento", "p_type"
        )

    def _appliances(self) -> DataFrame:
        return self._details(
            "p_size BETWEEN 15 AND 35", "tb015_cod_prd_eletro", "tb015_detalhamento", "p_brand"
        )

    def _clothing(self) -> DataFrame:
        return self._details(
            "p_size BETWEEN 30 AND 45", "tb016_cod_prd_vestuario", "tb016_detalhamento", "p_name"
        )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log: one state change per event; the user stands for the run."""
    return read(spark, sf_dir, "events").selectExpr(
        "user_id AS id_log",
        "event_id AS sequencia",
        "ts AS data_execucao",
        "event_type AS tipo_operacao",
        "CASE event_id % 10 WHEN 0 THEN 'ERRO' WHEN 1 THEN 'INICIADO' ELSE 'SUCESSO' END AS status",
        "CAST(value AS int) AS duracao",
    )
