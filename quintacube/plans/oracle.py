"""The same results in plain SQL, for engines that run it on the order-management tables.

The SQL follows the definitions (one aggregation per grouping, joins per grouping), not the way the
Spark jobs compute them.
"""

from __future__ import annotations

from quintacube.operators.cube import KEYS, MEASURES
from quintacube.plans.registry import CPF, NOW, PERIOD, SET_ORDER, set_name
from quintacube.sources.standins import FULL_RUN

_TABLES = {
    "vendas": """
        SELECT l_orderkey * 10 + l_linenumber AS cod, o_custkey AS cpf, l_partkey AS produto,
               l_suppkey AS matricula, o_orderdate AS data, l_linestatus AS estado,
               CAST(l_quantity AS INTEGER) AS quantidade,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS unitario,
               CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)
                    AS INTEGER) AS idData
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'""",
    "compras": """
        SELECT l_partkey AS produto, CAST(l_extendedprice AS DECIMAL(12,2)) AS unitario
        FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1""",
    "custo": """
        SELECT produto, CAST(avg(unitario) AS DECIMAL(20,8)) AS custo_medio
        FROM compras GROUP BY produto""",
    "loja": """
        SELECT n_nationkey AS idLoja, 'Loja ' || CAST(n_nationkey AS VARCHAR) AS nomeLoja,
               n_name AS cidade, r_name AS uf
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "func": "SELECT s_suppkey AS matricula, s_name AS nome, s_nationkey AS loja FROM supplier",
    "cargo": """
        SELECT user_id AS matricula, event_type AS nome_cargo FROM (
            SELECT user_id, event_type,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
            FROM events) WHERE rn = 1""",
    "detalhe": """
        SELECT p_partkey AS produto,
               CASE WHEN p_size <= 20 THEN p_type WHEN p_size BETWEEN 15 AND 35 THEN p_brand
                    WHEN p_size BETWEEN 30 AND 45 THEN p_name END AS detalhe
        FROM part""",
    "tempo": """
        SELECT DISTINCT idData, CAST(data AS DATE) AS dataCompleta,
               CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
               CAST(day(data) AS INTEGER) AS dia FROM vendas""",
    "log": """
        SELECT user_id AS id_log, event_id AS sequencia, ts AS data_execucao,
               event_type AS tipo_operacao,
               CASE event_id % 10 WHEN 0 THEN 'ERRO' WHEN 1 THEN 'INICIADO' ELSE 'SUCESSO' END
                   AS status,
               CAST(trunc(value) AS INTEGER) AS duracao FROM events""",
}
_NEEDS = {"custo": ("compras",), "tempo": ("vendas",)}


def _with(tables: str, body: str) -> str:
    """`body` with the listed helper tables, and those they need, in front."""
    wanted: list[str] = []
    for name in tables.split():
        for needed in (*_NEEDS.get(name, ()), name):
            if needed not in wanted:
                wanted.append(needed)
    ctes = ",\n".join(f"{name} AS ({_TABLES[name]})" for name in wanted)
    return f"WITH {ctes}\n{body}"


_KEY = {
    "t": ("idData", "v.idData"),
    "c": ("idCliente", "c.c_custkey"),
    "f": ("idFuncionario", "v.matricula"),
    "l": ("idLoja", "l.idLoja"),
    "p": ("idProduto", "p.p_partkey"),
}
_JOIN = {
    "c": " JOIN customer c ON v.cpf = c.c_custkey",
    "l": " JOIN func f ON v.matricula = f.matricula JOIN loja l ON f.loja = l.idLoja",
    "p": " JOIN part p ON v.produto = p.p_partkey",
}
_TYPE = {"t": "INTEGER", "c": "BIGINT", "f": "BIGINT", "l": "INTEGER", "p": "BIGINT"}
_CUBE_TABLES = "vendas custo func loja"


def _set(letters: str, where: str = "") -> str:
    gid = sum(bit for bit, k in zip((16, 8, 4, 2, 1), "tcflp", strict=True) if k not in letters)
    keys = ", ".join(
        f"{_KEY[k][1] if k in letters else f'CAST(-1 AS {_TYPE[k]})'} AS {_KEY[k][0]}"
        for k in "tcflp"
    )
    joins = "".join(_JOIN.get(k, "") for k in letters)
    group = ", ".join(_KEY[k][1] for k in letters)
    tail = f" GROUP BY {group}" if group else " HAVING count(*) > 0"
    return f"""
        SELECT CAST({gid} AS INTEGER) AS gid, {keys},
               CAST(sum(v.quantidade) AS BIGINT) AS quantidade,
               CAST(sum(v.unitario * v.quantidade) AS DECIMAL(18,2)) AS valor,
               CAST(sum((v.unitario - coalesce(k.custo_medio, 0)) * v.quantidade)
                    AS DECIMAL(18,2)) AS lucro
        FROM vendas v LEFT JOIN custo k ON v.produto = k.produto{joins}{where}{tail}"""


def _report(letters: str, body: str, tables: str = "") -> str:
    base = _with(f"{_CUBE_TABLES} {tables}", "")
    return f"{base.rstrip()},\nfato AS ({_set(letters)})\n{body}"


def _whole(body: str, tables: str = "") -> str:
    """`body` over the whole fact, all groupings."""
    base = _with(f"{_CUBE_TABLES} {tables}", "")
    return f"{base.rstrip()},\nfato AS ({' UNION ALL '.join(_set(s) for s in SET_ORDER)})\n{body}"


_DIM_PRODUTO = """
    SELECT CAST({id} AS {id_type}) AS idProduto, p_partkey AS codProdutoOrigem,
           p_name AS nomeProduto, p_brand AS categoria,
           coalesce(detalhe, 'Sem descrição detalhada') AS descricaoProduto
    FROM part JOIN detalhe ON p_partkey = produto
    UNION ALL SELECT -1, -1, 'Todos os Produtos', 'Total', 'Agregado de todos os produtos'"""
_DIM_CLIENTE = """
    SELECT CAST({id} AS {id_type}) AS idCliente, c_custkey AS cpf, c_name AS nomeCliente
    FROM customer UNION ALL SELECT -1, -1, 'Todos os Clientes'"""
_DIM_TEMPO = "SELECT * FROM tempo UNION ALL SELECT -1, NULL, -1, -1, -1"
_DIM_FUNCIONARIO = """
    SELECT f.matricula AS idFuncionario, CAST(f.matricula AS VARCHAR) AS cpf,
           f.nome AS nomeFuncionario, coalesce(g.nome_cargo, 'Cargo Não Definido') AS cargo
    FROM func f LEFT JOIN cargo g ON f.matricula = g.matricula
    UNION ALL SELECT -1, '-1', 'Todos os Funcionários', 'Total'"""
_DIM_LOJA = "SELECT * FROM loja UNION ALL SELECT -1, 'Todas as Lojas', 'Total', 'TT'"


def _unique(name: str, source: str, keys: str) -> str:
    return (
        f"SELECT '{name}' AS tabela, count(*) AS chaves_repetidas FROM "
        f"(SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
    )


def _orphans(name: str, source: str, key: str, parent: str, parent_key: str) -> str:
    """Rows of a source whose key, of one column or several, no parent row has."""
    pairs = list(zip(key.split(), parent_key.split(), strict=True))
    given = " AND ".join(f"a.{k} IS NOT NULL" for k, _ in pairs)
    same = " AND ".join(f"a.{k} = b.{p}" for k, p in pairs)
    return (
        f"SELECT '{name}' AS referencia, count(*) AS orfaos FROM {source} a WHERE {given} "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} b WHERE {same})"
    )


def _sentinels(name: str, source: str, keys: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, '{label}' AS chave, count(*) AS total "
        f"FROM {source} WHERE {key} = -1"
        for label, key in keys.items()
    )


def _counted(name: str, staged: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS tabela, (SELECT count(*) FROM {staged}) AS total, "
        f"(SELECT count(*) FROM {source}) AS esperado, "
        f"(SELECT count(*) FROM {staged}) = (SELECT count(*) FROM {source}) AS confere"
    )


# Bytes of a value: of a text its own, of the other types their fixed size.
_LENGTH = (
    "CASE WHEN {0} IS NULL THEN NULL WHEN typeof({0}) = 'VARCHAR' THEN strlen(CAST({0} AS VARCHAR)) "
    "WHEN typeof({0}) IN ('INTEGER', 'DATE') THEN 4 ELSE 8 END"
)


def _stats(name: str, source: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, '{c}' AS coluna, count(*) AS linhas, "
        f"count(*) - count({c}) AS nulos, CAST(min({c}) AS VARCHAR) AS menor, "
        f"CAST(max({c}) AS VARCHAR) AS maior, count(DISTINCT {c}) AS distintos, "
        f"CAST(ceil(avg({_LENGTH.format(c)})) AS BIGINT) AS tamanho_medio, "
        f"CAST(max({_LENGTH.format(c)}) AS BIGINT) AS tamanho_maior FROM {source}"
        for c in columns.split()
    )


def _members(name: str, source: str, key: str, label: str) -> str:
    return (
        f"SELECT '{name}' AS dimensao, CAST({key} AS BIGINT) AS chave, "
        f"CAST({label} AS VARCHAR) AS rotulo FROM ({source})"
    )


_UPSERT_SET = "cf"
_NATURAL_PRODUTO = _DIM_PRODUTO.format(id="p_partkey", id_type="BIGINT")
_NATURAL_CLIENTE = _DIM_CLIENTE.format(id="c_custkey", id_type="BIGINT")

ORACLE: dict[str, str] = {
    "src_scan": "SELECT * FROM orders",
    "src_scan_faixas": "SELECT * FROM orders",
    "stg_vendas": _with(
        "vendas",
        "SELECT cod AS tb010_012_cod_venda, cpf AS tb010_cpf, produto AS tb012_cod_produto, "
        "matricula AS tb005_matricula, data AS tb010_012_data, "
        "quantidade AS tb010_012_quantidade, unitario AS tb010_012_valor_unitario FROM vendas",
    ),
    "stg_compras": _with(
        "compras",
        "SELECT produto AS tb012_cod_produto, unitario AS tb012_017_valor_unitario FROM compras",
    ),
    "stg_clientes": "SELECT c_custkey AS tb010_cpf, c_name AS tb010_nome FROM customer",
    "stg_funcionarios": (
        "SELECT s_suppkey AS tb005_matricula, CAST(s_suppkey AS VARCHAR) AS tb005_cpf, "
        "s_name AS tb005_nome_completo, s_nationkey AS tb004_cod_loja FROM supplier"
    ),
    "stg_cargos_recentes": _with(
        "cargo", "SELECT matricula AS tb005_matricula, nome_cargo AS tb006_nome_cargo FROM cargo"
    ),
    "stg_produtos": (
        "SELECT p_partkey AS tb012_cod_produto, p_name AS tb012_descricao, p_brand AS categoria "
        "FROM part"
    ),
    "stg_produtos_detalhes": _with(
        "detalhe",
        "SELECT produto AS tb012_cod_produto, detalhe AS descricao_detalhada FROM detalhe",
    ),
    "stg_lojas": _with(
        "loja",
        "SELECT idLoja AS tb004_cod_loja, nomeLoja AS nome_loja, cidade, uf FROM loja",
    ),
    "dim_tempo": _with("tempo", _DIM_TEMPO),
    "dim_cliente": _DIM_CLIENTE.format(
        id="row_number() OVER (ORDER BY c_custkey)", id_type="BIGINT"
    ),
    "dim_funcionario": _with("func cargo", _DIM_FUNCIONARIO),
    "dim_produto": _with(
        "detalhe",
        _DIM_PRODUTO.format(id="row_number() OVER (ORDER BY p_partkey)", id_type="BIGINT"),
    ),
    "dim_loja": _with("loja", _DIM_LOJA),
    "dim_all_members": _with(
        "tempo func cargo detalhe loja",
        " UNION ALL ".join(
            [
                _members("Dim_Tempo", _DIM_TEMPO, "idData", "dataCompleta"),
                _members("Dim_Cliente", _NATURAL_CLIENTE, "idCliente", "nomeCliente"),
                _members("Dim_Funcionario", _DIM_FUNCIONARIO, "idFuncionario", "nomeFuncionario"),
                _members("Dim_Produto", _NATURAL_PRODUTO, "idProduto", "nomeProduto"),
                _members("Dim_Loja", _DIM_LOJA, "idLoja", "nomeLoja"),
            ]
        ),
    ),
    "custo_medio": _with("custo", "SELECT produto AS tb012_cod_produto, custo_medio FROM custo"),
    "lucro_por_venda": _with(
        "vendas custo",
        "SELECT v.cod AS tb010_012_cod_venda, v.produto AS tb012_cod_produto, "
        "v.unitario * v.quantidade AS valor, "
        "(v.unitario - coalesce(k.custo_medio, 0)) * v.quantidade AS lucro "
        "FROM vendas v LEFT JOIN custo k ON v.produto = k.produto",
    ),
    "fato_cube": _with(_CUBE_TABLES, " UNION ALL ".join(_set(s) for s in SET_ORDER)),
    "cube_slice": _with(_CUBE_TABLES, _set("cl")),
    **{set_name(i, s): _with(_CUBE_TABLES, _set(s)) for i, s in enumerate(SET_ORDER, start=1)},
    "insert_ignore": (
        "WITH alvo AS (SELECT c_custkey AS cpf, upper(c_name) AS nomeCliente FROM customer "
        "WHERE c_mktsegment = 'BUILDING'), "
        "chega AS (SELECT c_custkey AS cpf, c_name AS nomeCliente FROM customer "
        "UNION ALL SELECT o_custkey, '~ sem nome' FROM orders) "
        "SELECT * FROM alvo UNION ALL SELECT cpf, min(nomeCliente) AS nomeCliente FROM chega "
        "WHERE cpf NOT IN (SELECT cpf FROM alvo) GROUP BY cpf"
    ),
    "upsert_fact": _with(
        _CUBE_TABLES,
        f"SELECT * FROM ({_set(_UPSERT_SET, chr(10) + " WHERE v.estado = 'O'")}) UNION ALL "
        f"SELECT * FROM ({_set(_UPSERT_SET, chr(10) + " WHERE v.estado = 'F'")}) a "
        f"WHERE NOT EXISTS (SELECT 1 FROM vendas b JOIN customer ON b.cpf = c_custkey "
        "WHERE b.estado = 'O' AND b.cpf = a.idCliente AND b.matricula = a.idFuncionario)",
    ),
    "fato_incremental": _with(_CUBE_TABLES, " UNION ALL ".join(_set(s) for s in SET_ORDER)),
    "dim_cliente_continuado": (
        "SELECT row_number() OVER (ORDER BY c_mktsegment <> 'BUILDING', c_custkey) AS idCliente, "
        "c_custkey AS cpf, c_name AS nomeCliente FROM customer"
    ),
    "fato_sem_periodo": _with(
        _CUBE_TABLES,
        f"SELECT idData, idCliente, quantidade, valor FROM ({_set('tc')}) "
        "WHERE NOT coalesce(idData BETWEEN 19950101 AND 19951231, false)",
    ),
    "fato_estatisticas": _whole(
        " UNION ALL ".join(
            f"SELECT gid, '{c}' AS coluna, count(*) AS linhas, count(*) - count({c}) AS nulos, "
            f"CAST(min({c}) AS DECIMAL(38,8)) AS menor, CAST(max({c}) AS DECIMAL(38,8)) AS maior FROM fato GROUP BY gid"
            for c in (*KEYS, *MEASURES)
        )
    ),
    "fatia_agrupada": _report(
        "tc",
        "SELECT 'mes' AS fatia, idData, idCliente, quantidade, valor FROM fato WHERE idData // 100 = 199503 "
        f"UNION ALL SELECT 'cliente', idData, idCliente, quantidade, valor FROM fato WHERE idCliente = {CPF}",
    ),
    "q6_uf_mes_categoria": _with(
        f"{_CUBE_TABLES} tempo",
        "SELECT d.ano, d.mes, l.uf, p_brand AS categoria, CAST(sum(v.quantidade) AS BIGINT) AS quantidade, "
        "CAST(sum(v.unitario * v.quantidade) AS DECIMAL(18,2)) AS valor, "
        "CAST(sum((v.unitario - coalesce(k.custo_medio, 0)) * v.quantidade) AS DECIMAL(18,2)) AS lucro "
        "FROM vendas v LEFT JOIN custo k ON v.produto = k.produto JOIN tempo d ON v.idData = d.idData "
        "JOIN part ON v.produto = p_partkey JOIN func f ON v.matricula = f.matricula "
        "JOIN loja l ON f.loja = l.idLoja GROUP BY ALL",
    ),
    "q1_func_tempo": _report(
        "tf",
        "SELECT d.ano, d.mes, e.nome AS nomeFuncionario, f.valor AS ValorTotalVendas "
        "FROM fato f JOIN func e ON f.idFuncionario = e.matricula "
        "JOIN tempo d ON f.idData = d.idData ORDER BY 1, 2, 3",
        "tempo",
    ),
    "q2_func_volume": _report(
        "f",
        "SELECT e.nome AS nomeFuncionario, f.quantidade AS TotalProdutosVendidos, "
        "f.valor AS ValorTotalVendas FROM fato f JOIN func e ON f.idFuncionario = e.matricula "
        "ORDER BY 3 DESC",
    ),
    "q3_func_loja": _report(
        "fl",
        "SELECT e.nome AS nomeFuncionario, l.nomeLoja, l.cidade, l.uf, "
        "f.quantidade AS NumeroDeAtendimentos "
        "FROM fato f JOIN func e ON f.idFuncionario = e.matricula "
        "JOIN loja l ON f.idLoja = l.idLoja ORDER BY 1, 5 DESC",
    ),
    "q4_ultima_venda": _report(
        "tc",
        "SELECT c.c_name AS nomeCliente, f.valor AS valorTotal, d.dataCompleta "
        "FROM fato f JOIN customer c ON f.idCliente = c.c_custkey "
        "JOIN tempo d ON f.idData = d.idData "
        "JOIN (SELECT idCliente, max(idData) AS ultima FROM fato GROUP BY idCliente) u "
        "ON f.idCliente = u.idCliente AND f.idData = u.ultima ORDER BY 1",
        "tempo",
    ),
    "q5_cliente_periodo": _report(
        "tc",
        "SELECT c.c_name AS nomeCliente, f.valor AS ValorAcumulado, "
        "'Loja Virtual' AS tipo_loja, d.dataCompleta "
        "FROM fato f JOIN customer c ON f.idCliente = c.c_custkey "
        "JOIN tempo d ON f.idData = d.idData "
        f"WHERE d.dataCompleta BETWEEN '{PERIOD[0]}' AND '{PERIOD[1]}' ORDER BY 2 DESC",
        "tempo",
    ),
    "q6_categoria": _report(
        "p",
        "SELECT p_brand AS categoria, CAST(sum(f.quantidade) AS BIGINT) "
        "AS QuantidadeTotalVendida FROM fato f JOIN part ON f.idProduto = p_partkey "
        "GROUP BY p_brand ORDER BY 2 DESC",
    ),
    "q6_total": _report(
        "",
        "SELECT 'Total por Categoria' AS categoria, quantidade AS QuantidadeTotalVendida "
        "FROM fato",
    ),
    "q7_total_vendas": _report(
        "", "SELECT 'Total de Vendas' AS descricao, quantidade AS Quantidade FROM fato"
    ),
    "log_latest_state": _with(
        "log",
        "SELECT id_log, sequencia, data_execucao, tipo_operacao, status, duracao FROM ("
        "SELECT *, row_number() OVER (PARTITION BY id_log "
        "ORDER BY data_execucao DESC, sequencia DESC) AS rn FROM log) WHERE rn = 1",
    ),
    "log_purge_stuck": _with(
        "log",
        f"SELECT * FROM log WHERE NOT (status = 'INICIADO' AND "
        f"data_execucao < TIMESTAMP '{NOW}' - INTERVAL 2 MINUTE)",
    ),
    "log_running": _with(
        "log",
        f"SELECT count(*) > 0 AS em_execucao FROM log WHERE status = 'INICIADO' AND "
        f"data_execucao > TIMESTAMP '{NOW}' - INTERVAL 1 HOUR",
    ),
    "log_last_run_steps": _with(
        "log",
        "SELECT tipo_operacao, data_execucao, duracao, status FROM log WHERE data_execucao >= "
        f"(SELECT max(data_execucao) FROM log WHERE tipo_operacao = '{FULL_RUN}' "
        "AND status = 'SUCESSO') ORDER BY data_execucao",
    ),
    "log_recent": _with(
        "log", "SELECT * FROM log ORDER BY data_execucao DESC, sequencia DESC LIMIT 10"
    ),
    "log_counts": _with(
        "log",
        "SELECT tipo_operacao, status, count(*) AS total FROM log "
        "GROUP BY tipo_operacao, status ORDER BY tipo_operacao",
    ),
    "log_full_runs": _with(
        "log",
        "SELECT tipo_operacao, status, data_execucao FROM log "
        f"WHERE tipo_operacao = '{FULL_RUN}'",
    ),
    "log_status": _whole(
        "SELECT max(data_execucao) AS ultima_execucao, max(status) AS status, "
        "(SELECT count(*) FROM fato) AS total_vendas, "
        "(SELECT count(*) + 1 FROM customer) AS total_clientes, "
        "(SELECT count(*) + 1 FROM part) AS total_produtos FROM log "
        "WHERE data_execucao = (SELECT max(data_execucao) FROM log)",
        "log",
    ),
    "check_counts": _with(
        "vendas compras loja",
        " UNION ALL ".join(
            [
                _counted("vendas", "vendas", "vendas"),
                _counted("compras", "compras", "compras"),
                _counted("clientes", "customer", "customer"),
                _counted("produtos", "part", "part"),
                _counted("lojas", "loja", "nation"),
            ]
        ),
    ),
    "check_slice_count": _report(
        "tc",
        "SELECT (SELECT count(*) FROM fato) AS total_fatia, "
        "(SELECT count(*) FROM vendas) AS total_vendas",
    ),
    "check_date_keys": _whole(
        "SELECT DISTINCT idData, 'fato' AS somente_em FROM fato WHERE idData <> -1 AND idData NOT IN "
        "(SELECT idData FROM tempo) UNION ALL SELECT idData, 'dimensao' FROM tempo "
        "WHERE idData NOT IN (SELECT idData FROM fato)",
        "tempo",
    ),
    "check_unique": _whole(
        " UNION ALL ".join(
            [
                _unique("tb010_012_vendas", "vendas", "cod"),
                _unique("tb010_clientes", "customer", "c_custkey"),
                _unique("tb005_funcionarios", "supplier", "s_suppkey"),
                _unique("tb012_produtos", "part", "p_partkey"),
                _unique("tb012_017_compras", "compras", "produto"),
                _unique(
                    "Fato_Vendas", "fato", "idData, idCliente, idFuncionario, idLoja, idProduto"
                ),
            ]
        ),
        "compras",
    ),
    "check_client_by_cpf": f"SELECT * FROM ({_NATURAL_CLIENTE}) WHERE cpf = {CPF}",
    "check_fk": _whole(
        " UNION ALL ".join(
            [
                _orphans("cidade_uf", "loja", "uf", "region", "r_name"),
                _orphans("endereco_cidade", "loja", "idLoja uf", "loja", "idLoja uf"),
                _orphans("loja_endereco", "nation", "n_nationkey", "loja", "idLoja"),
                _orphans("funcionario_loja", "supplier", "s_nationkey", "nation", "n_nationkey"),
                _orphans("cargo_funcionario", "events", "user_id", "supplier", "s_suppkey"),
                _orphans("cargo_cargo", "events", "event_type", "events", "event_type"),
                _orphans("vendas_funcionario", "vendas", "matricula", "supplier", "s_suppkey"),
                _orphans("vendas_cliente", "vendas", "cpf", "customer", "c_custkey"),
                _orphans("vendas_produto", "vendas", "produto", "part", "p_partkey"),
                _orphans("compras_produto", "compras", "produto", "part", "p_partkey"),
                _orphans("produto_categoria", "part", "p_brand", "part", "p_brand"),
                *[
                    _orphans(
                        f"{name}_produto", f"(SELECT * FROM part WHERE {sizes})", "p_partkey", "part", "p_partkey"
                    )
                    for name, sizes in (
                        ("alimento", "p_size <= 20"),
                        ("eletro", "p_size BETWEEN 15 AND 35"),
                        ("vestuario", "p_size BETWEEN 30 AND 45"),
                    )
                ],
                *[
                    _orphans(f"fato_{key}", "fato", key, f"({dimension})", key)
                    for key, dimension in (
                        ("idData", _DIM_TEMPO),
                        ("idCliente", _NATURAL_CLIENTE),
                        ("idFuncionario", _DIM_FUNCIONARIO),
                        ("idLoja", _DIM_LOJA),
                        ("idProduto", _NATURAL_PRODUTO),
                    )
                ],
            ]
        ),
        "compras tempo cargo detalhe",
    ),
    "check_sentinel_free": _with(
        "vendas",
        " UNION ALL ".join(
            [
                _sentinels(
                    "tb010_012_vendas",
                    "vendas",
                    {
                        "tb010_cpf": "cpf",
                        "tb005_matricula": "matricula",
                        "tb012_cod_produto": "produto",
                    },
                ),
                _sentinels("tb010_clientes", "customer", {"tb010_cpf": "c_custkey"}),
                _sentinels(
                    "tb005_funcionarios",
                    "supplier",
                    {"tb005_matricula": "s_suppkey", "tb004_cod_loja": "s_nationkey"},
                ),
                _sentinels("tb012_produtos", "part", {"tb012_cod_produto": "p_partkey"}),
                _sentinels("tb004_lojas", "nation", {"tb004_cod_loja": "n_nationkey"}),
            ]
        ),
    ),
    "join_inner": _with(
        "vendas",
        "SELECT cod AS tb010_012_cod_venda, c_name AS tb010_nome "
        "FROM vendas JOIN customer ON cpf = c_custkey",
    ),
    "join_composite": _report(
        "tc",
        "SELECT f.idCliente, f.idData, f.valor FROM fato f JOIN (SELECT idCliente, "
        "max(idData) AS idData FROM fato GROUP BY idCliente) u "
        "ON f.idCliente = u.idCliente AND f.idData = u.idData",
    ),
    "join_left": _with(
        "custo",
        "SELECT p_partkey AS tb012_cod_produto, p_name AS tb012_descricao, custo_medio "
        "FROM part LEFT JOIN custo ON p_partkey = produto",
    ),
    "join_star": _with(
        "vendas func loja",
        "SELECT v.cod AS tb010_012_cod_venda, c_name AS nomeCliente, f.nome AS nomeFuncionario, "
        "l.nomeLoja, p_name AS nomeProduto, v.quantidade "
        "FROM vendas v JOIN customer ON v.cpf = c_custkey "
        "JOIN func f ON v.matricula = f.matricula JOIN loja l ON f.loja = l.idLoja "
        "JOIN part ON v.produto = p_partkey",
    ),
    "table_stats": _whole(
        " UNION ALL ".join(
            [
                _stats("Dim_Tempo", f"({_DIM_TEMPO})", "idData dataCompleta ano mes dia"),
                _stats("Dim_Cliente", f"({_NATURAL_CLIENTE})", "idCliente cpf nomeCliente"),
                _stats(
                    "Dim_Funcionario",
                    f"({_DIM_FUNCIONARIO})",
                    "idFuncionario cpf nomeFuncionario cargo",
                ),
                _stats(
                    "Dim_Produto",
                    f"({_NATURAL_PRODUTO})",
                    "idProduto codProdutoOrigem nomeProduto categoria descricaoProduto",
                ),
                _stats("Dim_Loja", f"({_DIM_LOJA})", "idLoja nomeLoja cidade uf"),
                _stats(
                    "Fato_Vendas",
                    "fato",
                    "gid idData idCliente idFuncionario idLoja idProduto quantidade valor lucro",
                ),
            ]
        ),
        "tempo cargo detalhe",
    ),
}
