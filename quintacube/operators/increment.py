"""Changes of a stored cube by new sales, without reading the old ones.

Every measure of the cube is a sum over the grain, so new sales are summed into a cube of their own and
added to the stored rows of the same keys. Old rows of the grain matter only if one of their lookups
has changed: a product's key or cost, an employee's store, a client who was unknown. Those rows
are taken back with their old lookups and added again with the new ones, in the same sum. Sums are
kept unrounded and rounded when a row is stored, so any number of increments equals one full load.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut, is_read, size_in_bytes, small_side
from quintacube.operators.cube import (
    KEYS, MEASURES, CubeInput, build_cube, has_keys, looked_up, store_lookup, summed_groupings, with_store_copies,
)

#: Bytes of the stored rows that one partition of a merge takes.
STORED_BYTES_A_PARTITION = 8 << 20

GRAIN_KEYS = ("idData", "cpf", "idFuncionario", "produto")


def changed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose other columns differ between two lookups, or that only one of them has."""
    others = [c for c in old.columns if c != key]
    # A key without any value looks up the same as a key that is missing.
    a, b = (x.select(key, F.struct(*others).alias(n)) for x, n in ((old, "a"), (new.select(old.columns), "b")))
    none = F.struct(*[F.lit(None).cast(old.schema[c].dataType).alias(c) for c in others])
    return a.join(b, key, "full").where(~F.coalesce("a", none).eqNullSafe(F.coalesce("b", none))).select(key)


def affected(grain: DataFrame, products: DataFrame, employees: DataFrame, clients: DataFrame) -> DataFrame | None:
    """Rows of the grain with a changed product, employee or client; None if nothing has changed."""
    marks, rows = [], grain
    for keys in (products, employees, clients):
        keys = cut(keys)
        if keys.isEmpty():
            continue
        (key,) = keys.columns
        mark = f"changed_{key}"
        rows = rows.join(small_side(cut(keys.distinct().withColumn(mark, F.lit(True)))), key, "left")
        marks.append(mark)
    if not marks:
        return None
    return rows.where(F.coalesce(*marks, F.lit(False))).drop(*marks)


def negated(rows: DataFrame) -> DataFrame:
    kinds = {c: rows.schema[c].dataType for c in MEASURES}
    return rows.withColumns({c: (-F.col(c)).cast(kind) for c, kind in kinds.items()})


def regrained(rows: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Rows of the grain with their lookups made anew."""
    kinds = {c: rows.schema[c].dataType for c in rows.columns}
    again = looked_up(rows.select(*GRAIN_KEYS, "quantidade", "valor"), products, stores)
    return again.select(*[F.col(c).cast(kinds[c]).alias(c) for c in rows.columns])


def delta_cube(m: CubeInput, new: DataFrame, old_clients: DataFrame, taken_back: DataFrame | None) -> DataFrame:
    """What to add to the stored cube, one row a key, all 32 groupings.

    `new` and `taken_back` are written rows of the grain; the latter is negative and found with the
    clients that were known before.
    """
    added = build_cube(m, new)
    if taken_back is None:
        return added
    both = added.unionByName(build_cube(replace(m, clients=old_clients), taken_back))
    return summed(both)


def summed(rows: DataFrame) -> DataFrame:
    """Rows of one key added up, in the types they have."""
    kinds = {c: rows.schema[c].dataType for c in MEASURES}
    return rows.groupBy("gid", *KEYS).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in kinds.items()])


def merged(stored: DataFrame, delta: DataFrame | CubeInput, grain: DataFrame | None = None) -> DataFrame:
    """Unrounded cube rows with the delta added; a key left with nothing sold goes.

    Nearly every key is on one side only, once. So the rows are dealt out before they are summed: sums
    on the way would hold every row in memory and spill, without making them fewer. Where the delta is
    still to be summed, from the written `grain`, `stored` holds the 24 summed groupings only and meets
    the sales as they are dealt out for their sums: the delta's rows are then never sent themselves.
    """
    if isinstance(delta, CubeInput):
        found = _with_store_copies_summed(delta, stored, summed_groupings(delta, grain, stored))
    else:
        delta = delta.select(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in stored.columns])
        known = sum(size_in_bytes(side) for side in (stored, delta) if is_read(side))
        least = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        both = stored.unionByName(delta).repartition(max(least, -(-known // STORED_BYTES_A_PARTITION)), "gid", *KEYS)
        found = summed(both)
    return found.where("NOT (quantidade = 0 AND valor = 0 AND lucro = 0)")


def _with_store_copies_summed(m: CubeInput, stored: DataFrame, rows: DataFrame) -> DataFrame:
    """All 32 groupings of the 24 summed ones, one row a key.

    An employee with rows of several stores has as many copies without the store; only these are summed again.
    """
    place = ["idFuncionario", "idLoja"]
    known = stored.where(has_keys("idFuncionario")).select(*place).unionByName(store_lookup(m).select(*place))
    several = cut(known.distinct().groupBy("idFuncionario").count().where("count > 1").select("idFuncionario"))
    found = with_store_copies(rows)
    if several.isEmpty():
        return found
    of_several, others = (found.join(small_side(several), "idFuncionario", how).select(found.columns) for how in ("left_semi", "left_anti"))
    return others.unionByName(summed(of_several))
