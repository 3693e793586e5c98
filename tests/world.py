"""A small shop made by rule, with the awkward rows in it, and brute-force answers about it.

Awkward on purpose: client 100 has a third of all sales, client 999 is not in the client table,
product 80 has no product row, product 7 was never bought, store 4 has no address, some products
average to half a cent, some sales fall one second before midnight, and employee 3 was promoted
twice at the same time.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
from itertools import product

from quintacube.operators.cube import KEYS, gid_of
from quintacube.sources.tables import inline_rows

N_SALES = 240
CLIENTS = [100, *range(101, 111)]
PRODUCTS = list(range(1, 11))
EMPLOYEES = list(range(1, 9))
STORE_OF = {e: 1 + e % 4 for e in EMPLOYEES}


def sale(i: int) -> dict:
    client = 100 if i % 3 == 0 else 999 if i % 17 == 0 else 101 + i % 10
    return {
        "id": i,
        "cpf": client,
        "produto": 80 if i % 19 == 0 else 1 + (i * 7) % 10,
        "matricula": 1 + (i + i // 8) % 8,
        "dia": (2024, 1 + i % 2, 1 + (i * 5) % 6),
        "quantidade": 1 + i % 4,
        "unitario": Decimal(100 + (i * 37) % 900) / 8,
    }


SALES = [sale(i) for i in range(N_SALES)]
PURCHASES = [
    (p, Decimal(1000 + 13 * p + k) / 100)
    for p in [*PRODUCTS, 80]
    if p != 7
    for k in range(1 + p % 4)
]


def tables(spark) -> dict:
    def t(name, rows, serial=None):
        return inline_rows(spark, name, rows, serial)

    def stamp(year, month, day):
        return f"{month}/{day}/{year}"

    text = {
        "tb001_uf": t("tb001_uf", [("PR", "Paraná"), ("SP", "São Paulo")]),
        "tb002_cidades": t(
            "tb002_cidades", [("PR", "Curitiba"), ("SP", "São Paulo")], "tb002_cod_cidade"
        ),
        "tb003_enderecos": t(
            "tb003_enderecos",
            [
                ("PR", 1, "Rua A", "1", None, None, "Centro", "80"),
                ("SP", 2, "Rua B", "2", None, None, "Centro", "81"),
                # City 1 is not in SP: the composite key must not match.
                ("SP", 1, "Rua C", "3", None, None, "Centro", "82"),
            ],
            "tb003_cod_endereco",
        ),
        "tb004_lojas": t(
            "tb004_lojas",
            [(1, None, "x", None), (2, 1, "x", None), (2, 1, "x", None), (None, 1, "x", None)],
            "tb004_cod_loja",
        ),
        "tb005_funcionarios": t(
            "tb005_funcionarios",
            [
                (STORE_OF[e], 1, f"{'ÁBÇ'[e % 3]} func {e}", "1/1/1990", f"00{e}", "r", "Ativo",
                 "1/1/2010", None)
                for e in EMPLOYEES
            ],
            "tb005_matricula",
        ),
        "tb005_006_funcionarios_cargos": t(
            "tb005_006_funcionarios_cargos",
            [
                (1, 1, "10.00", "0", "3/4/2015"),
                (1, 2, "10.00", "0", "7/8/2016"),
                (2, 1, "10.00", "0", "5/6/2015"),
                (3, 3, "10.00", "0", "7/8/2016"),
                (3, 2, "10.00", "0", "7/8/2016"),
                (3, 1, "10.00", "0", "6/9/2016"),
                (4, 9, "10.00", "0", "6/9/2016"),
            ],
        ),
        "tb006_cargos": t("tb006_cargos", [("Balcão",), ("Estoque",), ("Turno",)],
                          "tb006_cod_cargo"),
        "tb010_clientes": t(
            "tb010_clientes", [(c, f"Cliente {c}", "1", None) for c in CLIENTS]
        ),
        "tb010_012_vendas": t(
            "tb010_012_vendas",
            [
                (s["id"], s["cpf"], s["produto"], s["matricula"], stamp(*s["dia"]),
                 s["quantidade"], s["unitario"])
                for s in SALES
            ],
        ).selectExpr(
            "* EXCEPT (tb010_012_data)",
            "CASE WHEN tb010_012_cod_venda % 5 = 0 THEN tb010_012_data + INTERVAL 86399 SECONDS "
            "ELSE tb010_012_data END AS tb010_012_data",
        ),
        "tb012_017_compras": t(
            "tb012_017_compras",
            [(p, 1, "1/1/2023", 5, price) for p, price in PURCHASES],
            "tb012_017_cod_compra",
        ),
        "tb012_produtos": t(
            "tb012_produtos", [(p, 1 + p % 3, f"Produto {p}") for p in PRODUCTS]
        ),
        "tb013_categorias": t(
            "tb013_categorias", [("Alimentos",), ("Eletros",), ("Roupas",)], "tb013_cod_categoria"
        ),
        "tb014_prd_alimentos": t(
            "tb014_prd_alimentos",
            [(1, "pão", "kg", None, None, None), (1, "arroz", "kg", None, None, None),
             (2, "sal", "kg", None, None, None)],
            "tb014_cod_prd_alimentos",
        ),
        "tb015_prd_eletros": t(
            "tb015_prd_eletros",
            [(2, "tv", None, None, None), (3, "rádio", None, None, None),
             (3, "fogão", None, None, None)],
            "tb015_cod_prd_eletro",
        ),
        "tb016_prd_vestuarios": t(
            "tb016_prd_vestuarios",
            [(3, "calça", "M", None, None, None), (4, "blusa", "F", None, None, None)],
            "tb016_cod_prd_vestuario",
        ),
    }
    return text


# ------------------------------------------------------------------ brute force

KNOWN_STORES = {1, 2, 3}


def average_cost(p: int) -> Fraction:
    """Average purchase price cut to the eight decimals the warehouse keeps; 0 if never bought."""
    prices = [Fraction(price) for product_id, price in PURCHASES if product_id == p]
    if not prices:
        return Fraction(0)
    exact = sum(prices, Fraction(0)) / len(prices)
    return Fraction(round_half_up(exact, 8))


def round_half_up(value: Fraction, places: int) -> Decimal:
    scaled = value * 10**places
    whole = (abs(scaled) + Fraction(1, 2)).__floor__()
    return Decimal(whole if scaled >= 0 else -whole).scaleb(-places)


def key_of(s: dict, key: str):
    """Key of a sale, or None where its dimension does not know it."""
    if key == "idData":
        year, month, day = s["dia"]
        return year * 10000 + month * 100 + day
    if key == "idCliente":
        return s["cpf"] if s["cpf"] in CLIENTS else None
    if key == "idFuncionario":
        return s["matricula"]
    if key == "idLoja":
        store = STORE_OF[s["matricula"]]
        return store if store in KNOWN_STORES else None
    return s["produto"] if s["produto"] in PRODUCTS else None


def grouping(keys, sales=None) -> dict:
    """Rows of one grouping as {key tuple: (quantity, value, profit)}, with -1 for "all"."""
    sums: dict = {}
    for s in SALES if sales is None else sales:
        found = tuple(key_of(s, k) if k in keys else -1 for k in KEYS)
        if None in found:
            continue
        price = Fraction(s["unitario"])
        q, v, p = sums.get(found, (0, Fraction(0), Fraction(0)))
        sums[found] = (
            q + s["quantidade"],
            v + price * s["quantidade"],
            p + (price - average_cost(s["produto"])) * s["quantidade"],
        )
    return {
        k: (q, round_half_up(v, 2), round_half_up(p, 2)) for k, (q, v, p) in sums.items()
    }


def cube() -> dict:
    """{(gid, *keys): measures} of all groupings."""
    result = {}
    for use in product((True, False), repeat=len(KEYS)):
        keys = tuple(k for k, used in zip(KEYS, use, strict=True) if used)
        for found, measures in grouping(keys).items():
            result[(gid_of(keys), *found)] = measures
    return result


def natural(fact, dims):
    """Cube rows with surrogate client and product keys turned back, as {keys: measures}."""
    clients = {r["idCliente"]: r["cpf"] for r in dims["Dim_Cliente"].collect()}
    products = {r["idProduto"]: r["codProdutoOrigem"] for r in dims["Dim_Produto"].collect()}
    rows = {}
    for r in fact.collect():
        key = (
            r["gid"], r["idData"], clients[r["idCliente"]], r["idFuncionario"], r["idLoja"],
            products[r["idProduto"]],
        )
        assert key not in rows, f"twice in the cube: {key}"
        rows[key] = (r["quantidade"], r["valor"], r["lucro"])
    return rows


def cents(value) -> Decimal:
    return Decimal(value).quantize(Decimal("0.01"), ROUND_HALF_UP)
