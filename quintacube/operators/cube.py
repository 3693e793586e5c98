"""The sales cube over date, client, employee, store and product.

A rolled-up key holds -1. `gid` tells the groupings apart the way `grouping_id()` does: one bit per
key, highest for the date, set when the key is rolled up.

A grouping joins only the dimensions of its own keys, so a sale whose client, product or store is
unknown counts in every grouping that does not use that key. Date and employee come from the sale
itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quintacube.functions.expressions import ALL, DATE_KEY, line_profit, line_value
from quintacube.functions.sizing import cut, size_in_bytes, small_side, union_all
from quintacube.operators.cost import COST_TYPE, average_cost

KEYS = ("idData", "idCliente", "idFuncionario", "idLoja", "idProduto")
MEASURES = ("quantidade", "valor", "lucro")
COLUMNS = ("gid", *KEYS, *MEASURES)
_BIT = {key: 1 << (len(KEYS) - 1 - i) for i, key in enumerate(KEYS)}

#: Bytes, and rows, of the written grain that one partition of the cube takes: a row is copied up to 12 times
#: there, and the copies' sums must fit a task's share of the memory twice (300,000 rows take some 0.8 GB).
GRAIN_BYTES_A_PARTITION = 16 << 20
GRAIN_ROWS_A_PARTITION = 300_000
COPIES_OF_A_ROW = 12

# Widths that keep the scale of `valor - custo * quantidade`: with a decimal(20,8) cost the product
# is decimal(36,8) and the difference decimal(37,8). Wider ones pass 38 digits and lose decimals.
_QUANTITY_AT_GRAIN = "decimal(15,0)"
_VALUE_DIGITS_AT_GRAIN = 27


@dataclass(frozen=True)
class Measures:
    """Stored types; the defaults hold totals far beyond NUMERIC(12,2) and INTEGER."""

    quantity: str = "bigint"
    money: str = "decimal(18,2)"


@dataclass(frozen=True)
class CubeInput:
    sales: DataFrame
    clients: DataFrame
    employees: DataFrame
    stores: DataFrame
    products: DataFrame
    cost: DataFrame
    measures: Measures = Measures()


def cube_input(stg, dims, measures: Measures = Measures(), cost_type: str = COST_TYPE) -> CubeInput:
    """Cut staging and dimensions to the columns the cube needs."""
    return CubeInput(
        sales=stg["vendas"].selectExpr(
            f"{DATE_KEY.format('tb010_012_data')} AS idData",
            "tb010_cpf AS cpf",
            "tb005_matricula AS idFuncionario",
            "tb012_cod_produto AS produto",
            "tb010_012_quantidade AS quantidade",
            "tb010_012_valor_unitario AS unitario",
        ),
        clients=dims["Dim_Cliente"].where(f"idCliente <> {ALL}").select("cpf", "idCliente"),
        employees=stg["funcionarios"].selectExpr(
            "tb005_matricula AS idFuncionario", "tb004_cod_loja AS idLoja"
        ),
        stores=dims["Dim_Loja"].where(f"idLoja <> {ALL}").select("idLoja"),
        products=dims["Dim_Produto"]
        .where(f"idProduto <> {ALL}")
        .selectExpr("codProdutoOrigem AS produto", "idProduto"),
        cost=average_cost(stg["compras"], cost_type).withColumnRenamed(
            "tb012_cod_produto", "produto"
        ),
        measures=measures,
    )


def grouping_sets() -> list[tuple[str, ...]]:
    """The 32 key subsets, by size and then in key order."""
    chosen = [
        tuple(k for k, used in zip(KEYS, use, strict=True) if used)
        for use in product((True, False), repeat=len(KEYS))
    ]
    return sorted(chosen, key=len)


def gid_of(keys: Iterable[str]) -> int:
    return sum(_BIT.values()) - sum(_BIT[k] for k in set(keys))


def _stored(rows: DataFrame, measures: Measures, known: Sequence[str] = KEYS) -> DataFrame:
    """Round once, when the row is stored, and drop groups whose key is unknown."""
    return rows.dropna(subset=list(known)).selectExpr(
        "gid",
        *KEYS,
        f"CAST(quantidade AS {measures.quantity}) AS quantidade",
        *[f"CAST({c} AS {measures.money}) AS {c}" for c in ("valor", "lucro") if c in rows.columns],
    )


def _employee_store(m: CubeInput) -> DataFrame:
    """Store of each employee, NULL where the store is not in its dimension."""
    known = m.stores.withColumnRenamed("idLoja", "_loja")
    return m.employees.join(known, m.employees["idLoja"] == known["_loja"], "left").select(
        "idFuncionario", F.col("_loja").alias("idLoja")
    )


def _grain_profit(rows: DataFrame) -> DataFrame:
    """Profit of rows already summed within one product: the cost is constant there."""
    value_scale = rows.schema["valor"].dataType.scale
    value = F.col("valor").cast(f"decimal({_VALUE_DIGITS_AT_GRAIN},{value_scale})")
    cost = F.coalesce("custo_medio", F.lit(0).cast(rows.schema["custo_medio"].dataType))
    result = rows.withColumn(
        "lucro", value - cost * F.col("quantidade").cast(_QUANTITY_AT_GRAIN)
    ).withColumn("valor", value)
    _require_scale(result, rows.schema["custo_medio"].dataType.scale)
    return result


def _require_scale(rows: DataFrame, scale: int) -> None:
    if rows.schema["lucro"].dataType.scale < scale:
        raise ValueError("the profit would lose decimals: use a narrower cost type")


def cube_set(m: CubeInput, keys: Sequence[str], profit: bool = True) -> DataFrame:
    """One grouping of the cube, straight from the sales; without `profit` no cost is computed.

    Lookups that are part of the key follow the aggregation, where fewer rows are left; the cost
    comes first only when the product is not in the key, so that the sums can combine before the
    shuffle.
    """
    chosen = [k for k in KEYS if k in set(keys)]
    by_product = "idProduto" in chosen
    rows = m.sales
    if "idLoja" in chosen:
        place = small_side(_employee_store(m).dropna(subset=["idLoja"]))
        rows = rows.join(place, "idFuncionario")
    source_key = {"idCliente": "cpf", "idProduto": "produto"}
    group = [source_key.get(k, k) for k in chosen]
    price, quantity = F.col("unitario"), F.col("quantidade")
    value = F.sum(line_value(price, quantity)).alias("valor")
    if by_product:
        summed = rows.groupBy(*group).agg(F.sum(quantity).alias("quantidade"), value)
        lookup = m.products.join(m.cost, "produto", "left") if profit else m.products
        summed = summed.join(small_side(lookup), "produto")
        if profit:
            summed = _grain_profit(summed)
    elif not profit:
        summed = rows.groupBy(*group).agg(F.sum(quantity).alias("quantidade"), value)
    else:
        gain = F.sum(line_profit(price, F.col("custo_medio"), quantity)).alias("lucro")
        summed = (
            rows.join(small_side(m.cost), "produto", "left")
            .groupBy(*group)
            .agg(F.sum(quantity).alias("quantidade"), value, gain)
        )
        _require_scale(summed, m.cost.schema["custo_medio"].dataType.scale)
    if "idCliente" in chosen:
        summed = summed.join(small_side(m.clients), "cpf")
    types = _key_types(m)
    rolled_up = {k: f"CAST({ALL} AS {types[k].simpleString()}) AS {k}" for k in KEYS}
    named = summed.selectExpr(
        f"{gid_of(chosen)} AS gid",
        *[k if k in chosen else rolled_up[k] for k in KEYS],
        *[c for c in MEASURES if profit or c != "lucro"],
    )
    # No sales, no fact rows: a total over nothing would be a row of NULL measures.
    return _stored(named.dropna(subset=["quantidade"]) if not chosen else named, m.measures)


def _key_types(m: CubeInput) -> dict:
    return {
        "idData": m.sales.schema["idData"].dataType,
        "idCliente": m.clients.schema["idCliente"].dataType,
        "idFuncionario": m.sales.schema["idFuncionario"].dataType,
        "idLoja": m.stores.schema["idLoja"].dataType,
        "idProduto": m.products.schema["idProduto"].dataType,
    }


# ---------------------------------------------------------------------------------------------
# Full cube
#
# Every employee has one store, so the groupings by employee and by employee with store hold the
# same groups: 24 groupings are summed and the other 8 are copied from them.
#
# The groupings that contain the client are all computed from one partitioning by client, those
# that contain the product but not the client from one partitioning by product, and the rest from
# the small date x employee sums. The sales are shuffled three times in all, however many
# groupings there are, where an expand-and-aggregate would shuffle one copy per grouping.
# ---------------------------------------------------------------------------------------------


def summed_sales(m: CubeInput) -> DataFrame:
    """Sales summed by their keys; copies of one sale combine before the shuffle."""
    price, quantity = F.col("unitario"), F.col("quantidade")
    return m.sales.groupBy("idData", "cpf", "idFuncionario", "produto").agg(
        F.sum(quantity).alias("quantidade"), F.sum(line_value(price, quantity)).alias("valor")
    )


def product_lookup(m: CubeInput) -> DataFrame:
    """Key and cost by product code; a product may be known without ever being bought, or bought unknown."""
    return m.products.join(m.cost, "produto", "full")


def store_lookup(m: CubeInput) -> DataFrame:
    return _employee_store(m)


def looked_up(summed: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Summed sales with store, product key and profit. Unknown stores and products stay as NULL."""
    rows = summed.join(small_side(products), "produto", "left").join(small_side(stores), "idFuncionario", "left")
    return _grain_profit(rows).drop("custo_medio")


def sales_grain(m: CubeInput) -> DataFrame:
    """Sales summed by their keys, with store, product key and profit; lookups meet the summed rows only."""
    return looked_up(summed_sales(m), product_lookup(m), store_lookup(m))


def heavy_keys(rows: DataFrame, keys: Sequence[str], parts: int, count: int | None = None) -> dict[str, list]:
    """For each key column, the values that hold more than 1/parts of the rows.

    By arithmetic there are fewer than `parts` of them per column, so they may come to the driver.
    """
    limit = (rows.count() if count is None else count) / parts

    def of(key: str) -> list:
        counted = rows.dropna(subset=[key]).groupBy(key).agg(F.count("*").alias("_n"))
        return [row[key] for row in counted.where(F.col("_n") > limit).collect()]

    return {key: of(key) for key in keys}


def _all_of(rows: DataFrame, key: str) -> str:
    """SQL of the "all" key in the type of a column."""
    return f"CAST({ALL} AS {rows.schema[key].dataType.simpleString()})"


class _Numbers:
    """Money of the grain as whole numbers, which add up several times faster than wide decimals.

    An amount is kept in its smallest unit, or where the total of all amounts could leave a long, as
    units and fraction. Amounts beyond that, found by the same total, stay decimals. Every way is exact.
    """

    #: A 64th of what a long holds.
    ROOM = 1 << 57

    def __init__(self, rows: DataFrame, stored: DataFrame | None = None):
        money = [c for c in MEASURES if isinstance(rows.schema[c].dataType, T.DecimalType)]
        found = [F.count("*").alias("rows"), *[F.sum(F.abs(F.col(c).cast("double"))).alias(c) for c in money]]
        total = rows.agg(*found).first().asDict()
        self.rows, self.stored = total["rows"], 0
        if stored is not None:  # a sum takes in the rows of one grouping at most
            by_gid = stored.groupBy("gid").agg(*found)
            most = by_gid.agg(F.sum("rows").alias("stored"), *[F.max(c).alias(c) for c in ("rows", *money)]).first()
            self.stored = most["stored"] or 0
            total = {c: (total[c] or 0) + (most[c] or 0) for c in total}
        most_rows = total["rows"]
        self._kinds = {c: rows.agg(F.sum(c).alias(c)).schema[c].dataType for c in MEASURES}
        self._columns: dict[str, tuple[str, ...]] = {}
        for c in money:
            scale, most = rows.schema[c].dataType.scale, total[c] or 0.0
            if scale <= 9 and most * 10**scale < self.ROOM:
                self._columns[c] = (c,)
            elif scale <= 9 and most + most_rows < self.ROOM and most_rows * 10**scale < self.ROOM:
                self._columns[c] = (f"{c}_unidades", f"{c}_fracao")

    @property
    def names(self) -> list[str]:
        return [name for c in MEASURES for name in self._columns.get(c, (c,))]

    def sums(self) -> list[Column]:
        return [F.sum(name).alias(name) for name in self.names]

    def split(self, rows: DataFrame) -> DataFrame:
        found = []
        for c in MEASURES:
            names = self._columns.get(c)
            if names is None:
                found.append(c)
                continue
            scale = rows.schema[c].dataType.scale
            # The total proves that this holds it; wider types would lose decimals in what follows.
            value = f"CAST({c} AS decimal({20 + scale},{scale}))"
            if len(names) == 1:
                found.append(f"CAST({value} * {10**scale} AS bigint) AS {c}")
            else:
                fraction = f"CAST({value} - FLOOR({value}) AS decimal({scale + 1},{scale}))"
                found.append(f"CAST(FLOOR({value}) AS bigint) AS {names[0]}")
                found.append(f"CAST({fraction} * {10**scale} AS bigint) AS {names[1]}")
        return rows.selectExpr(*[c for c in rows.columns if c not in MEASURES], *found)

    def joined(self, rows: DataFrame) -> DataFrame:
        """The sums as decimals, in the types that sums of the decimals have."""
        found = []
        for c in MEASURES:
            names, kind = self._columns.get(c), self._kinds[c].simpleString()
            scale = self._kinds[c].scale if names else 0
            if names is None:
                found.append(c)
                continue
            unit = f"CAST(1 / {10**scale}BD AS decimal({scale + 1},{scale}))"
            if len(names) == 1:
                value = f"CAST({c} AS decimal(20,0)) * {unit}"
            else:
                value = f"CAST({names[0]} AS decimal({20 + scale},{scale})) + CAST({names[1]} AS decimal(20,0)) * {unit}"
            found.append(f"CAST({value} AS {kind}) AS {c}")
        return rows.selectExpr(*[c for c in rows.columns if c not in self.names], *found)


def _levels(rows: DataFrame, fixed: Sequence[str], free: Sequence[str], finest: bool = True) -> DataFrame:
    """One copy of each row per grouping that uses all `fixed` and any of the `free` keys.

    `gid` treats the employee as carrying the store: the store column stays filled beside it.
    Without `finest` the grouping of all these keys is left out. Rows that have a `gid` stay as they are.
    """
    all_of = {k: _all_of(rows, k) for k in free}

    def level(used: set[str]) -> str:
        keys = [f"{k if k in used else all_of[k]} AS {k}" for k in KEYS if k in free]
        return f"struct({', '.join([f'{gid_of(used)} AS gid', *keys])})"

    places = [(), ("idLoja",), ("idFuncionario", "idLoja")]
    others = [[(), (k,)] for k in free if k not in ("idLoja", "idFuncionario")]
    sets = [{*fixed, *sum(combo, ())} for combo in product(places, *others)]
    copies = [level(used) for used in sets if finest or used != {*fixed, *free}]
    kept = [c for c in rows.columns if c not in free and c != "gid"]
    made = f"array({', '.join(copies)})"
    if "gid" in rows.columns:
        made = f"CASE WHEN gid IS NULL THEN {made} ELSE array(struct({', '.join(['gid', *[k for k in KEYS if k in free]])})) END"
    return rows.selectExpr(*kept, f"inline({made})")


def with_store_copies(rows: DataFrame) -> DataFrame:
    """Emit each employee group a second time without its store; groups of an unknown store go."""
    kept = [c for c in rows.columns if c not in ("gid", "idLoja")]
    same = "struct(gid, idLoja)"
    without = f"struct(gid + {_BIT['idLoja']} AS gid, {_all_of(rows, 'idLoja')} AS idLoja)"
    by_employee = f"(gid & {_BIT['idFuncionario']}) = 0"
    return rows.selectExpr(
        *kept,
        f"inline(CASE WHEN {by_employee} THEN array({same}, {without}) ELSE array({same}) END)",
    ).dropna(subset=["idLoja"]).select(rows.columns)


def _sets_with(
    rows: DataFrame,
    anchor: str,
    known: Callable[[DataFrame, DataFrame | None], DataFrame],
    free: Sequence[str],
    heavy: list,
    parts: int,
    sums: Sequence[Column],
) -> DataFrame:
    """All groupings that contain the key found through `anchor`, from one shuffle of the rows.

    Rows are partitioned by the anchor once; every grouping then aggregates inside its partition.
    Anchors heavier than an average partition take the other way: their copies are combined before
    a shuffle on the whole group key. `known` resolves the anchor to its dimension key; for heavy
    anchors it is given their values.
    """
    rows = rows.dropna(subset=[anchor])

    def summed(part: DataFrame) -> DataFrame:
        fixed = [k for k in KEYS if k in part.columns and k not in free]
        copies = _levels(part, fixed, free)
        group = ["gid", *[k for k in KEYS if k in copies.columns]]
        if anchor in group:
            return copies.groupBy(*group).agg(*sums)
        return copies.groupBy(anchor, *group).agg(*sums).drop(anchor)

    # The partition count is given, as small partitions must not be merged before their rows are
    # copied once per grouping. In order of the anchor, sums that are added to together lie together, and
    # the written keys compress.
    def dealt(part: DataFrame) -> DataFrame:
        return known(part.repartition(parts, anchor), None).sortWithinPartitions(anchor)

    if not heavy:
        return summed(dealt(rows))
    few = rows.sparkSession.createDataFrame(
        [(value,) for value in heavy],
        T.StructType([T.StructField(anchor, rows.schema[anchor].dataType)]),
    )
    light = dealt(rows.join(F.broadcast(few), anchor, "left_anti"))
    hot = rows.join(F.broadcast(few), anchor, "left_semi")
    return summed(light).unionByName(summed(known(hot, few)))


def build_cube(m: CubeInput, rows: DataFrame | None = None) -> DataFrame:
    """All 32 groupings; `rows` as in `summed_groupings`."""
    return with_store_copies(summed_groupings(m, rows))


def all_groupings(written: DataFrame) -> DataFrame:
    """All 32 groupings from the written rows of `summed_groupings`.

    The 8 groupings by employee without the store are read from the rows that carry it. Both reads
    take a filter on `gid` down to the folders.
    """
    by_employee = written.where(f"(gid & {_BIT['idFuncionario']}) = 0")
    without = {"gid": f"gid + {_BIT['idLoja']}", "idLoja": _all_of(written, "idLoja")}
    copies = by_employee.selectExpr(*[f"{without.get(c, c)} AS {c}" for c in written.columns])
    return written.dropna(subset=["idLoja"]).unionByName(copies)


def summed_groupings(m: CubeInput, rows: DataFrame | None = None, stored: DataFrame | None = None) -> DataFrame:
    """The 24 groupings that are summed: those by employee carry the store, NULL where it is unknown.

    `rows` may be the result of `sales_grain` read back from a written table; without it the grain
    is written here. Either way every branch below starts from files and reads only its columns:
    none of them repeats the joins, and a lost executor costs a re-read.

    `stored` may hold written rows of the same 24 groupings, unrounded, to add to. They are dealt out
    beside the sales and summed with the copies of these, so the new groupings do not cross the network again.
    """
    rows = cut(sales_grain(m)) if rows is None else rows
    types = _key_types(m)
    grain_bytes = size_in_bytes(rows)
    if stored is not None:
        kinds = {c: stored.schema[c].dataType for c in MEASURES}
        _require_scale(stored, rows.schema["lucro"].dataType.scale)
        rows = rows.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})
    numbers = _Numbers(rows, stored)
    # Every row is copied up to 12 times in its partition, so the written grain sets their number; stored rows are not.
    parts = max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        -(-grain_bytes // GRAIN_BYTES_A_PARTITION),
        -(-(numbers.rows + numbers.stored // COPIES_OF_A_ROW) // GRAIN_ROWS_A_PARTITION),
    )
    place = ["idData", "idFuncionario", "idLoja"]
    measures, sums = numbers.names, numbers.sums()

    def with_client(part: DataFrame, heavy: DataFrame | None) -> DataFrame:
        if heavy is None:
            return part.join(m.clients, "cpf")
        # The clients of the heavy keys only: no more rows than `heavy` has.
        few = m.clients.join(F.broadcast(heavy), "cpf", "left_semi")
        return part.join(F.broadcast(few), "cpf")

    def found(part: DataFrame, heavy: DataFrame | None) -> DataFrame:
        return part

    if stored is None:
        heavy = heavy_keys(rows, ("cpf", "produto"), parts, numbers.rows)
        anchors = (("cpf", heavy["cpf"], with_client), ("produto", heavy["produto"], found))
    else:
        # Stored rows have no source keys, so both sides meet by the keys of the dimensions.
        of_clients = rows.join(small_side(m.clients), "cpf")
        anchors = tuple(
            (k, _heavy_in_both(side, stored, k, parts, numbers), found)
            for k, side in (("idCliente", of_clients), ("idProduto", rows))
        )
        old, of_clients = numbers.split(stored), numbers.split(of_clients)
    rows = numbers.split(rows)

    def dealt_out(part: DataFrame, keys: Sequence[str], *without: str) -> DataFrame:
        """The sales, and the stored rows of the groupings by the first of `keys`; only these have a `gid`."""
        if stored is None:
            return part
        known = old.where(has_keys(keys[0], without=without)).select("gid", *keys, *measures)
        return part.withColumn("gid", F.lit(None).cast(stored.schema["gid"].dataType)).unionByName(known)

    (client, heavy_clients, join_clients), (goods, heavy_goods, join_goods) = anchors
    by_client = _sets_with(
        dealt_out(
            (rows if stored is None else of_clients).select(client, *place, "idProduto", *measures),
            ["idCliente", *place, "idProduto"],
        ),
        client,
        join_clients,
        [*place, "idProduto"],
        heavy_clients,
        parts,
        sums,
    )
    by_product = _sets_with(
        dealt_out(
            rows.dropna(subset=["idProduto"]).select(*dict.fromkeys([goods, "idProduto"]), *place, *measures),
            ["idProduto", *place],
            "idCliente",
        ),
        goods,
        join_goods,
        place,
        heavy_goods,
        parts,
        sums,
    )
    # These sums are one of the groupings already; only the others, which are far smaller, are summed again.
    by_place = rows.groupBy(*place).agg(*sums)
    finest = by_place.withColumn("gid", F.lit(gid_of(place)))
    rest = _levels(by_place, [], place, finest=False)
    if stored is None:
        rest = rest.groupBy("gid", *place).agg(*sums)
    else:
        neither = old.where(has_keys(without=["idCliente", "idProduto"])).select("gid", *place, *measures)
        both = finest.unionByName(neither.where(F.col("gid") == gid_of(place)))
        finest = both.groupBy("gid", *place).agg(*sums)
        rest = rest.unionByName(neither.where(F.col("gid") != gid_of(place))).groupBy("gid", *place).agg(*sums)

    def complete(part: DataFrame) -> DataFrame:
        rolled_up = [k for k in KEYS if k not in part.columns]
        filled = numbers.joined(part).selectExpr(
            "*", *[f"CAST({ALL} AS {types[k].simpleString()}) AS {k}" for k in rolled_up]
        )
        return _stored(filled, m.measures, [k for k in KEYS if k != "idLoja"])

    return union_all([complete(part) for part in (by_client, by_product, finest, rest)])


def has_keys(*keys: str, without: Sequence[str] = ()) -> Column:
    """Whether a row's grouping has these keys, and none of some others."""
    used, rolled_up = sum(_BIT[k] for k in keys), sum(_BIT[k] for k in without)
    return F.col("gid").bitwiseAND(used | rolled_up) == rolled_up


def _heavy_in_both(rows: DataFrame, stored: DataFrame, key: str, parts: int, numbers: _Numbers) -> list:
    """Values that hold more than an average partition of the sales, or of the stored rows."""
    old = stored.where(has_keys(key, without=["idCliente"] if key == "idProduto" else []))
    few = heavy_keys(rows, (key,), parts, numbers.rows)[key] + heavy_keys(old, (key,), parts, numbers.stored)[key]
    return sorted(set(few))


def cube_slice(fact: DataFrame, keys: Iterable[str]) -> DataFrame:
    """One grouping of a stored cube; the filter on `gid` prunes to one folder of the table."""
    chosen = set(keys)
    condition = F.col("gid") == gid_of(chosen)
    for key in KEYS:
        condition &= (F.col(key) != ALL) if key in chosen else (F.col(key) == ALL)
    return fact.where(condition)


# ---------------------------------------------------------------------------------------------
# Stored cube: unrounded sums beside the rounded ones
# ---------------------------------------------------------------------------------------------

EXACT = {"valor": "valor_exato", "lucro": "lucro_exato"}


def exact_measures(grain: DataFrame, measures: Measures) -> Measures:
    """Types that keep every decimal of the grain's profit."""
    return Measures(measures.quantity, f"decimal(38,{grain.schema['lucro'].dataType.scale})")


def with_rounded(exact: DataFrame, measures: Measures) -> DataFrame:
    """Unrounded cube rows as they are stored: rounded once, the unrounded sums beside them."""
    return exact.selectExpr(
        "gid",
        *KEYS,
        f"CAST(quantidade AS {measures.quantity}) AS quantidade",
        *[f"CAST({c} AS {measures.money}) AS {c}" for c in EXACT],
        *[f"{c} AS {kept}" for c, kept in EXACT.items()],
    )


def unrounded(stored: DataFrame) -> DataFrame:
    return stored.selectExpr("gid", *KEYS, "quantidade", *[f"{kept} AS {c}" for c, kept in EXACT.items()])
