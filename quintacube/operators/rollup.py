"""Roll-ups of a stored cube to attributes, each from the smallest stored rows that can give it.

A view is a choice of levels: a key of the cube or an attribute above it (month, year, city, state,
category), at most one a key; a key without a level is summed up whole. The 32 groupings of the cube are
views of keys only, and views with attributes may be stored beside them. A stored view answers
another if it is at least as fine in every key. Where it is finer by a whole key, every sale must have
that key: a grouping leaves out sales whose member is unknown, and a sum over it would too.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.functions.sizing import small_side, union_all
from quintacube.operators.cube import KEYS, MEASURES, cube_slice, gid_of, grouping_sets

View = tuple[str, ...]

#: Levels of each key, from fine to coarse, in the order of the keys.
CHAINS = (("idData", "mes", "ano"), ("idCliente",), ("idFuncionario",), ("idLoja", "cidade", "uf"), ("idProduto", "categoria"))
#: Columns of an attribute; those of a coarser one are among those of a finer one.
ATTRIBUTES = {"mes": ("ano", "mes"), "ano": ("ano",), "cidade": ("cidade", "uf"), "uf": ("uf",), "categoria": ("categoria",)}
_DIMENSION = {"idData": "Dim_Tempo", "idLoja": "Dim_Loja", "idProduto": "Dim_Produto"}


def view(levels: Iterable[str]) -> View:
    """The levels in the order of the keys."""
    levels = list(levels)
    found = [level for chain in CHAINS for level in chain if level in levels]
    if len(found) != len(levels) or any(sum(x in levels for x in chain) > 1 for chain in CHAINS):
        raise ValueError(f"not a choice of at most one level a key: {levels}")
    return tuple(found)


def lattice() -> list[View]:
    """All views."""
    return [tuple(x for x in levels if x) for levels in product(*[(*chain, "") for chain in CHAINS])]


def keys_of(levels: View) -> tuple[str, ...]:
    return tuple(chain[0] for chain in CHAINS if any(x in levels for x in chain))


def columns_of(levels: View) -> list[str]:
    return [c for level in levels for c in ATTRIBUTES.get(level, (level,))]


def can_answer(stored: View, wanted: View, complete: Collection[str]) -> bool:
    for chain in CHAINS:
        has = [i for i, x in enumerate(chain) if x in stored]
        needs = [i for i, x in enumerate(chain) if x in wanted]
        if needs and (not has or has[0] > needs[0]):
            return False
        if has and not needs and chain[0] not in complete:
            return False
    return True


def smallest(sizes: Mapping[View, int], wanted: View, complete: Collection[str]) -> View:
    """The view with the fewest rows among those that can give the wanted one."""
    able = [v for v in sizes if can_answer(v, wanted, complete)]
    if not able:
        raise LookupError(f"no stored view gives {wanted}")
    return min(able, key=lambda v: (sizes[v], len(v), v))


def complete_keys(grain: DataFrame, clients: DataFrame) -> set[str]:
    """Keys that every sale has. `grain` is the summed sales with their lookups, `clients` the known cpf."""
    others = [k for k in KEYS if k != "idCliente"]
    missing = grain.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in others]).first()
    found = {k for k in others if missing[k] == 0}
    if grain.groupBy("cpf").agg(F.lit(1)).join(clients, "cpf", "left_anti").isEmpty():
        found.add("idCliente")
    return found


def grouping_sizes(fact: DataFrame) -> dict[View, int]:
    """Rows of the 32 groupings; only file footers are read."""
    counted = {r["gid"]: r["count"] for r in fact.groupBy("gid").count().collect()}
    return {view(keys): counted.get(gid_of(keys), 0) for keys in grouping_sets()}


def _with_attributes(rows: DataFrame, stored: View, wanted: View, dims: Mapping[str, DataFrame]) -> DataFrame:
    for chain in CHAINS:
        key, level = chain[0], next((x for x in chain if x in wanted), None)
        if key in stored and level in ATTRIBUTES:
            rows = rows.join(small_side(dims[_DIMENSION[key]].select(key, *ATTRIBUTES[level])), key)
    return rows


def rolled_up(rows: DataFrame, stored: View, wanted: View, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The wanted view from the rows of one that can answer it; sums keep their types."""
    kinds = {m: rows.schema[m].dataType for m in MEASURES}
    if stored == wanted:
        return rows.select(*columns_of(wanted), *MEASURES)
    found = _with_attributes(rows, stored, wanted, dims).groupBy(*columns_of(wanted))
    sums = found.agg(*[F.sum(m).cast(kind).alias(m) for m, kind in kinds.items()])
    return sums if wanted else sums.dropna(subset=["quantidade"])


def grouping(fact: DataFrame, stored: View) -> DataFrame:
    return cube_slice(fact, stored).select(*stored, *MEASURES)


def estimated_sizes(fact: DataFrame, dims: Mapping[str, DataFrame], views: Sequence[View]) -> dict[View, int]:
    """Rows that views with attributes would have, by sketches: one pass over the keys of each grouping.

    A view's attributes come from the grouping of exactly its keys, so no sale is left out.
    """
    by_keys: dict[View, list[View]] = {}
    for v in views:
        by_keys.setdefault(keys_of(v), []).append(v)

    def counted(keys: View, wanted: list[View]) -> DataFrame:
        rows = cube_slice(fact, keys).select(*keys)
        for key in keys:
            fine = next((x for x in CHAINS[KEYS.index(key)][1:] if any(x in v for v in wanted)), None)
            if fine:
                rows = rows.join(small_side(dims[_DIMENSION[key]].select(key, *ATTRIBUTES[fine])), key)
        # A struct with a NULL in it is no NULL, so an attribute without value counts as one.
        sizes = [F.approx_count_distinct(F.struct(*columns_of(v))).alias(str(i)) for i, v in enumerate(wanted)]
        pairs = [F.struct(F.lit(",".join(v)).alias("v"), F.col(str(i)).alias("n")) for i, v in enumerate(wanted)]
        return rows.agg(*sizes).select(F.inline(F.array(*pairs)))

    if not views:
        return {}
    found = union_all([counted(k, vs) for k, vs in by_keys.items()]).collect()
    return {tuple(r["v"].split(",")): r["n"] for r in found}


def choose(
    stored: Mapping[View, int], candidates: Mapping[View, int], wanted: Sequence[View], count: int, complete: Collection[str]
) -> list[View]:
    """Up to `count` candidates to store, by greatest benefit: rows that all wanted views together save.

    The greedy choice saves at least 63 % of what the best choice of as many views would.
    """
    sizes, chosen = dict(stored), []

    def saved(v: View) -> int:
        cost = {w: sizes[smallest(sizes, w, complete)] for w in wanted if can_answer(v, w, complete)}
        return sum(max(0, rows - candidates[v]) for rows in cost.values())

    for _ in range(count):
        left = [v for v in candidates if v not in sizes]
        best = max(left, key=lambda v: (saved(v), v), default=None)
        if best is None or saved(best) == 0:
            break
        sizes[best] = candidates[best]
        chosen.append(best)
    return chosen
