"""Named queries over the order-management tables, one per operator or report."""

from __future__ import annotations

from collections import UserDict
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut, small_side, union_all
from quintacube.operators import checks, cost, cube, dimensions, increment, layout, loads, rollup, runlog, sketches, staging
from quintacube.operators.surrogate import continued_ids, dense_ids
from quintacube.plans import reports
from quintacube.sources import standins
from quintacube.sources.tables import range_predicates

NOW = "2024-01-15 12:00:00"
PERIOD = ("1995-01-01", "1996-12-31")
CPF = 7

_LETTER = dict(zip(cube.KEYS, "tcflp", strict=True))

# Order of the groupings in the inventory, by their keys' letters.
SET_ORDER = (
    "", "t", "c", "f", "l", "p", "tc", "tf", "tl", "tp", "cf", "cl", "cp", "fl", "fp", "lp",
    "tcf", "tcl", "tcp", "tfl", "tfp", "tlp", "cfl", "cfp", "clp", "flp",
    "tcfl", "tcfp", "tclp", "tflp", "cflp", "tcflp",
)


def keys_of(letters: str) -> tuple[str, ...]:
    return tuple(k for k in cube.KEYS if _LETTER[k] in letters)


def set_name(number: int, letters: str) -> str:
    return f"cube_{number:02d}_{letters or 'total'}"


class Staged(UserDict):
    """Staging tables of a model, each built when it is first asked for."""

    def __init__(self, sources: standins.RetailTables):
        super().__init__()
        self._sources = sources

    def __missing__(self, name: str) -> DataFrame:
        if name == "cargos_mais_recentes":
            self[name] = staging.latest_jobs(self._sources, "event_id")
        else:
            self[name] = staging.BUILDERS[name](self._sources)
        return self[name]


class Dimensions(UserDict):
    """Dimensions with natural keys, which are whole numbers here; built when asked for."""

    def __init__(self, sources: standins.RetailTables, stg: Staged):
        super().__init__()
        self._sources, self._stg = sources, stg

    def __missing__(self, name: str) -> DataFrame:
        self[name] = dimensions.build_dimension(name, self._sources, self._stg, surrogate=False)
        return self[name]


class Model:
    """Everything a query may need, built lazily from the tables below `sf_dir`."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.sources = standins.RetailTables(spark, sf_dir)
        self.stg = Staged(self.sources)
        self.plain_dims = Dimensions(self.sources, self.stg)

    def read(self, table: str) -> DataFrame:
        return standins.read(self.spark, self.sf_dir, table)

    @cached_property
    def cube_input(self) -> cube.CubeInput:
        return cube.cube_input(self.stg, self.plain_dims)

    @cached_property
    def fact(self) -> DataFrame:
        """All 32 groupings; the 24 that are summed are written once, one folder each."""
        return cube.all_groupings(cut(cube.summed_groupings(self.cube_input), partition_by="gid"))

    @cached_property
    def whole_fact(self) -> DataFrame:
        """All 32 groupings, written once, one folder each."""
        return cut(cube.build_cube(self.cube_input), partition_by="gid")

    @cached_property
    def fact_in_one(self) -> DataFrame:
        """All 32 groupings from the 24 that are summed, written as they are: those of a client or product lie together."""
        return cube.with_store_copies(cut(cube.summed_groupings(self.cube_input)))

    @cached_property
    def fact_keys(self) -> DataFrame:
        """The keys of all 32 groupings, from those of the 24 that are summed, written once."""
        summed = cube.summed_groupings(self.cube_input).select("gid", *cube.KEYS)
        return cube.with_store_copies(cut(summed, partition_by="gid"))

    @property
    def log(self) -> DataFrame:
        return standins.run_log(self.spark, self.sf_dir)

    def grouping(self, *keys: str, profit: bool = False) -> DataFrame:
        return cube.cube_set(self.cube_input, keys, profit)


def _stg(name: str):
    return lambda m: m.stg[name]


def _cube_set(letters: str):
    return lambda m: m.grouping(*keys_of(letters), profit=True)


def _report(name: str):
    def run(m: Model) -> DataFrame:
        args = PERIOD if name == "q5_cliente_periodo" else ()
        return reports.REPORTS[name](m.grouping(*reports.GROUPING[name]), m.plain_dims, *args)

    return run


def dim_all_members(m: Model) -> DataFrame:
    """Key and label of every member of every dimension, "all" members included."""
    label = {
        "Dim_Tempo": ("idData", F.col("dataCompleta").cast("string")),
        "Dim_Cliente": ("idCliente", F.col("nomeCliente")),
        "Dim_Funcionario": ("idFuncionario", F.col("nomeFuncionario")),
        "Dim_Produto": ("idProduto", F.col("nomeProduto")),
        "Dim_Loja": ("idLoja", F.col("nomeLoja")),
    }
    dims = m.plain_dims
    parts = [
        dims[name].select(
            F.lit(name).alias("dimensao"),
            F.col(key).cast("bigint").alias("chave"),
            text.alias("rotulo"),
        )
        for name, (key, text) in label.items()
    ]
    return union_all(parts)


def insert_ignore(m: Model) -> DataFrame:
    """Clients loaded on top of those of one market segment, whose names stay as they were."""
    client = [F.col("c_custkey").alias("cpf"), F.col("c_name").alias("nomeCliente")]
    customer = m.read("customer")
    loaded = customer.where("c_mktsegment = 'BUILDING'").select(
        client[0], F.upper("c_name").alias("nomeCliente")
    )
    arriving = customer.select(*client).unionByName(
        m.read("orders").select(
            F.col("o_custkey").alias("cpf"), F.lit("~ sem nome").alias("nomeCliente")
        )
    )
    return loads.insert_ignore(loaded, arriving, "cpf", [F.asc("nomeCliente")])


def _needed(m: Model) -> dict[str, DataFrame]:
    return {name: m.stg[name] for name in ("compras", "funcionarios")}


def upsert_fact(m: Model) -> DataFrame:
    """Client-employee groups of the open lines replace those of the finished ones."""

    def part(state: str) -> DataFrame:
        lines = m.read("lineitem").where(f"l_returnflag <> 'R' AND l_linestatus = '{state}'")
        sold = {"tb010_012_vendas": standins.sold_lines(lines, m.read("orders"))}
        given = cube.cube_input({**_needed(m), "vendas": staging.sales(sold)}, m.plain_dims)
        return cube.cube_set(given, ("idCliente", "idFuncionario"))

    return loads.upsert_fact(part("F"), part("O"))


def _exact(m: Model, given: cube.CubeInput) -> tuple[cube.CubeInput, DataFrame]:
    """The input with types that keep every decimal, and its written grain."""
    grain = cut(cube.sales_grain(given))
    return replace(given, measures=cube.exact_measures(grain, cube.Measures())), grain


def fato_incremental(m: Model) -> DataFrame:
    """The cube of the finished lines with the open lines added to it: no finished line is read again."""
    def part(state: str) -> tuple[cube.CubeInput, DataFrame]:
        lines = m.read("lineitem").where(f"l_returnflag <> 'R' AND l_linestatus = '{state}'")
        sold = staging.sales({"tb010_012_vendas": standins.sold_lines(lines, m.read("orders"))})
        return _exact(m, cube.cube_input({**_needed(m), "vendas": sold}, m.plain_dims))

    finished = cube.with_rounded(cube.summed_groupings(*part("F")), cube.Measures())
    stored = cube.unrounded(cut(finished))
    return cube.with_rounded(increment.merged(stored, *part("O")), cube.Measures()).select(*cube.COLUMNS)


def dim_cliente_continuado(m: Model) -> DataFrame:
    """Clients of one market segment first; those of the others get the following ids."""
    columns = [F.col("c_custkey").alias("cpf"), F.col("c_name").alias("nomeCliente")]
    customer = m.read("customer")
    first = cut(dense_ids(customer.where("c_mktsegment = 'BUILDING'").select(*columns), "cpf", "idCliente"))
    return first.unionByName(continued_ids(first, customer.select(*columns), "cpf", "idCliente"))


def fato_sem_periodo(m: Model) -> DataFrame:
    """What a delete of one year leaves of the written client-day groups; unknown counts as not deleted."""
    groups = cut(m.grouping("idData", "idCliente"))
    return loads.delete_where(groups, F.col("idData").between(19950101, 19951231)).select("idData", "idCliente", "quantidade", "valor")


def fatia_agrupada(m: Model) -> DataFrame:
    """One month, and one client, of the client-day groups written along the curve."""
    groups = cut(layout.clustered(m.grouping("idData", "idCliente")), partition_by="gid")
    month = groups.where(F.col("idData").between(19950301, 19950331)).withColumn("fatia", F.lit("mes"))
    client = groups.where(F.col("idCliente") == CPF).withColumn("fatia", F.lit("cliente"))
    return month.unionByName(client).select("fatia", "idData", "idCliente", "quantidade", "valor")


def q6_uf_mes_categoria(m: Model) -> DataFrame:
    """Quantity, value and profit by state, month and category, from the smallest grouping that gives them."""
    given, grain = _exact(m, m.cube_input)
    fact = cube.all_groupings(cut(cube.summed_groupings(given, grain), partition_by="gid"))
    wanted = rollup.view(["mes", "uf", "categoria"])
    source = rollup.smallest(rollup.grouping_sizes(fact), wanted, rollup.complete_keys(grain, given.clients.select("cpf")))
    rows = rollup.rolled_up(rollup.grouping(fact, source), source, wanted, m.plain_dims)
    return rows.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("valor", "lucro")})


def fato_estatisticas(m: Model) -> DataFrame:
    """Rows, NULLs and bounds of every grouping's columns, merged from statistics of its files."""
    rows = m.whole_fact.withColumn("arquivo", F.col("_metadata.file_path"))
    return sketches.merged(cut(sketches.file_statistics(rows))).select("gid", "coluna", "linhas", "nulos", "menor", "maior")


def src_scan_faixas(m: Model) -> DataFrame:
    """The orders that lie in exactly one of the ranges which a parallel scan by client would take."""
    orders = m.read("orders")
    ranges = range_predicates(orders, "o_custkey", 16, "o_orderkey")
    hits = [F.when(F.expr(p), 1).otherwise(0) for p in ranges]
    return orders.where(sum(hits[1:], hits[0]) == 1)


def log_status(m: Model) -> DataFrame:
    dims = m.plain_dims
    return runlog.status_summary(
        m.log, m.fact, dims["Dim_Cliente"], dims["Dim_Produto"]
    )


def check_counts(m: Model) -> DataFrame:
    """Staged tables keep every source row."""
    names = {
        "vendas": "tb010_012_vendas",
        "compras": "tb012_017_compras",
        "clientes": "tb010_clientes",
        "produtos": "tb012_produtos",
        "lojas": "tb004_lojas",
    }
    return checks.table_counts(
        {name: m.stg[name] for name in names},
        {name: m.sources[source] for name, source in names.items()},
    )


def check_unique(m: Model) -> DataFrame:
    s = m.sources
    return checks.unique_keys(
        {
            "tb010_012_vendas": (s["tb010_012_vendas"], ["tb010_012_cod_venda"]),
            "tb010_clientes": (s["tb010_clientes"], ["tb010_cpf"]),
            "tb005_funcionarios": (s["tb005_funcionarios"], ["tb005_matricula"]),
            "tb012_produtos": (s["tb012_produtos"], ["tb012_cod_produto"]),
            "tb012_017_compras": (s["tb012_017_compras"], ["tb012_cod_produto"]),
            "Fato_Vendas": (m.fact_keys, cube.KEYS),
        }
    )


def check_fk(m: Model) -> DataFrame:
    """Every declared reference between the source tables that are read, and those of the fact."""
    s, d = m.sources, m.plain_dims
    product, city = "tb012_cod_produto", ["tb002_cod_cidade", "tb001_sigla_uf"]
    declared = {
        "cidade_uf": ("tb002_cidades", "tb001_sigla_uf", "tb001_uf"),
        "endereco_cidade": ("tb003_enderecos", city, "tb002_cidades"),
        "loja_endereco": ("tb004_lojas", "tb003_cod_endereco", "tb003_enderecos"),
        "funcionario_loja": ("tb005_funcionarios", "tb004_cod_loja", "tb004_lojas"),
        "cargo_funcionario": ("tb005_006_funcionarios_cargos", "tb005_matricula", "tb005_funcionarios"),
        "cargo_cargo": ("tb005_006_funcionarios_cargos", "tb006_cod_cargo", "tb006_cargos"),
        "vendas_funcionario": ("tb010_012_vendas", "tb005_matricula", "tb005_funcionarios"),
        "vendas_cliente": ("tb010_012_vendas", "tb010_cpf", "tb010_clientes"),
        "vendas_produto": ("tb010_012_vendas", product, "tb012_produtos"),
        "compras_produto": ("tb012_017_compras", product, "tb012_produtos"),
        "produto_categoria": ("tb012_produtos", "tb013_cod_categoria", "tb013_categorias"),
        "alimento_produto": ("tb014_prd_alimentos", product, "tb012_produtos"),
        "eletro_produto": ("tb015_prd_eletros", product, "tb012_produtos"),
        "vestuario_produto": ("tb016_prd_vestuarios", product, "tb012_produtos"),
    }
    dimension = dict(zip(cube.KEYS, reports.DIMENSION_OF_KEY, strict=True))
    return checks.foreign_keys(
        {name: (s[child], key, s[parent], key) for name, (child, key, parent) in declared.items()}
        | {f"fato_{key}": (m.fact, key, d[name], key) for key, name in dimension.items()}
    )


def check_sentinel_free(m: Model) -> DataFrame:
    s = m.sources
    return checks.sentinel_free(
        {
            "tb010_012_vendas": (
                s["tb010_012_vendas"],
                ["tb010_cpf", "tb005_matricula", "tb012_cod_produto"],
            ),
            "tb010_clientes": (s["tb010_clientes"], ["tb010_cpf"]),
            "tb005_funcionarios": (
                s["tb005_funcionarios"], ["tb005_matricula", "tb004_cod_loja"],
            ),
            "tb012_produtos": (s["tb012_produtos"], ["tb012_cod_produto"]),
            "tb004_lojas": (s["tb004_lojas"], ["tb004_cod_loja"]),
        }
    )


def join_inner(m: Model) -> DataFrame:
    return m.stg["vendas"].join(m.stg["clientes"], "tb010_cpf").select(
        "tb010_012_cod_venda", "tb010_nome"
    )


def join_composite(m: Model) -> DataFrame:
    """Client-day groups joined with each client's last day on both keys."""
    fact = cut(m.grouping("idData", "idCliente"))  # both sides read the written groups, not the sales twice
    last = fact.groupBy("idCliente").agg(F.max("idData").alias("idData"))
    return fact.join(last, ["idCliente", "idData"]).select("idCliente", "idData", "valor")


def join_left(m: Model) -> DataFrame:
    return m.stg["produtos"].join(
        cost.average_cost(m.stg["compras"]), "tb012_cod_produto", "left"
    ).select("tb012_cod_produto", "tb012_descricao", "custo_medio")


def join_star(m: Model) -> DataFrame:
    """Each sale with client, employee, store and product names."""
    d = m.plain_dims
    sales = m.stg["vendas"].select(
        "tb010_012_cod_venda",
        F.col("tb010_cpf").alias("cpf"),
        F.col("tb005_matricula").alias("idFuncionario"),
        F.col("tb012_cod_produto").alias("codProdutoOrigem"),
        F.col("tb010_012_quantidade").alias("quantidade"),
    )
    employee = m.stg["funcionarios"].select(
        F.col("tb005_matricula").alias("idFuncionario"),
        F.col("tb005_nome_completo").alias("nomeFuncionario"),
        F.col("tb004_cod_loja").alias("idLoja"),
    ).join(d["Dim_Loja"].select("idLoja", "nomeLoja"), "idLoja")
    return (
        sales.join(small_side(d["Dim_Cliente"].select("cpf", "nomeCliente")), "cpf")
        .join(small_side(employee), "idFuncionario")
        .join(small_side(d["Dim_Produto"].select("codProdutoOrigem", "nomeProduto")), "codProdutoOrigem")
        .select(
            "tb010_012_cod_venda",
            "nomeCliente",
            "nomeFuncionario",
            "nomeLoja",
            "nomeProduto",
            "quantidade",
        )
    )


def table_stats(m: Model) -> DataFrame:
    d = m.plain_dims
    return checks.column_stats(
        {
            "Dim_Tempo": d["Dim_Tempo"],
            "Dim_Cliente": d["Dim_Cliente"],
            "Dim_Funcionario": d["Dim_Funcionario"],
            "Dim_Produto": d["Dim_Produto"],
            "Dim_Loja": d["Dim_Loja"],
            "Fato_Vendas": m.fact_in_one,
        },
        analyze=True,
    )


QUERIES: dict[str, Callable[[Model], DataFrame]] = {
    "src_scan": lambda m: m.read("orders"),
    "src_scan_faixas": src_scan_faixas,
    "stg_vendas": _stg("vendas"),
    "stg_compras": _stg("compras"),
    "stg_clientes": _stg("clientes"),
    "stg_funcionarios": _stg("funcionarios"),
    "stg_cargos_recentes": _stg("cargos_mais_recentes"),
    "stg_produtos": _stg("produtos"),
    "stg_produtos_detalhes": _stg("produtos_detalhes"),
    "stg_lojas": _stg("lojas"),
    "dim_tempo": lambda m: m.plain_dims["Dim_Tempo"],
    "dim_cliente": lambda m: dimensions.with_all_member(
        dimensions.dim_client(m.stg["clientes"]), "Dim_Cliente"
    ),
    "dim_funcionario": lambda m: m.plain_dims["Dim_Funcionario"],
    "dim_produto": lambda m: dimensions.with_all_member(
        dimensions.dim_product(m.stg["produtos"], m.sources), "Dim_Produto"
    ),
    "dim_loja": lambda m: m.plain_dims["Dim_Loja"],
    "dim_all_members": dim_all_members,
    "custo_medio": lambda m: cost.average_cost(m.stg["compras"]),
    "lucro_por_venda": lambda m: cost.profit_per_sale(
        m.stg["vendas"], cost.average_cost(m.stg["compras"])
    ).select("tb010_012_cod_venda", "tb012_cod_produto", "valor", "lucro"),
    "fato_cube": lambda m: cube.build_cube(m.cube_input),
    "cube_slice": lambda m: cube.cube_slice(m.fact, ("idCliente", "idLoja")),
    **{set_name(i, s): _cube_set(s) for i, s in enumerate(SET_ORDER, start=1)},
    "insert_ignore": insert_ignore,
    "upsert_fact": upsert_fact,
    "fato_incremental": fato_incremental,
    "dim_cliente_continuado": dim_cliente_continuado,
    "fato_sem_periodo": fato_sem_periodo,
    "fato_estatisticas": fato_estatisticas,
    "fatia_agrupada": fatia_agrupada,
    "q6_uf_mes_categoria": q6_uf_mes_categoria,
    **{name: _report(name) for name in reports.REPORTS},
    "log_latest_state": lambda m: runlog.latest_state(m.log, F.desc("sequencia")),
    "log_purge_stuck": lambda m: runlog.purge_stuck(m.log, NOW),
    "log_running": lambda m: runlog.running(m.log, NOW),
    "log_last_run_steps": lambda m: runlog.last_run_steps(m.log, standins.FULL_RUN),
    "log_recent": lambda m: runlog.recent(m.log, 10, F.desc("sequencia")),
    "log_counts": lambda m: runlog.counts(m.log),
    "log_full_runs": lambda m: runlog.full_runs(m.log, standins.FULL_RUN),
    "log_status": log_status,
    "check_counts": check_counts,
    "check_slice_count": lambda m: checks.slice_count(
        m.grouping("idData", "idCliente"), m.stg["vendas"]
    ),
    "check_date_keys": lambda m: checks.date_keys(m.fact, m.plain_dims["Dim_Tempo"]),
    "check_client_by_cpf": lambda m: checks.client_by_cpf(m.plain_dims["Dim_Cliente"], CPF),
    "check_unique": check_unique,
    "check_fk": check_fk,
    "check_sentinel_free": check_sentinel_free,
    "join_inner": join_inner,
    "join_composite": join_composite,
    "join_left": join_left,
    "join_star": join_star,
    "table_stats": table_stats,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](Model(spark, sf_dir))
