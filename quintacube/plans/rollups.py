"""Roll-ups of the stored warehouse: which to keep beside the cube, and answers from the smallest one.

Stored roll-ups belong to one state of the fact. A load that changes the fact publishes a version
without them, so an answer never mixes two states; `store_rollups` makes them anew.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.functions.sizing import temporary_tables
from quintacube.operators import cube, rollup
from quintacube.plans.full_run import DERIVED, DIMENSIONS, FACT, GRAIN, warehouse_root
from quintacube.sources import versions

#: One row a stored view: its levels, its rows, and the keys that every sale has.
CATALOGUE = f"{DERIVED}_lista"


def rollup_name(levels: rollup.View) -> str:
    return "_".join((DERIVED, "de", *levels))


def _dims(spark: SparkSession, root: str, version: versions.Version) -> dict[str, DataFrame]:
    return {name: versions.read(spark, root, version, name) for name in DIMENSIONS}


def _exact_fact(spark: SparkSession, root: str, version: versions.Version) -> DataFrame:
    return cube.unrounded(versions.read(spark, root, version, FACT))


def _measured(spark: SparkSession, root: str, version: versions.Version) -> tuple[dict[rollup.View, int], set[str]]:
    clients = versions.read(spark, root, version, "Dim_Cliente").where("idCliente <> -1").select("cpf")
    grain = versions.read(spark, root, version, GRAIN)
    return rollup.grouping_sizes(versions.read(spark, root, version, FACT)), rollup.complete_keys(grain, clients)


def stored_views(spark: SparkSession, out: str, version: versions.Version) -> tuple[dict[rollup.View, int], set[str]]:
    """Rows of every stored view, and the keys that every sale has; measured if no roll-ups are stored."""
    root = warehouse_root(out)
    if CATALOGUE not in version.tables:
        return _measured(spark, root, version)
    rows = versions.read(spark, root, version, CATALOGUE).collect()  # a row a view: at most 192
    return {tuple(r["niveis"]): r["linhas"] for r in rows}, set(rows[0]["completas"])


def store_rollups(
    spark: SparkSession, out: str, wanted: Sequence[Sequence[str]] | None = None, count: int = 4
) -> list[rollup.View]:
    """Store up to `count` views with attributes, chosen for what the wanted views cost; returns them.

    By default every view is wanted. Each is computed from the smallest view stored so far.
    """
    root = warehouse_root(out)
    before = versions.current(spark, root)
    with temporary_tables(spark):
        sizes, complete = _measured(spark, root, before)
        fact, dims = _exact_fact(spark, root, before), _dims(spark, root, before)
        views = [rollup.view(w) for w in wanted] if wanted is not None else rollup.lattice()
        candidates = [v for v in rollup.lattice() if v not in sizes and any(rollup.can_answer(v, w, complete) for w in views)]
        chosen = rollup.choose(sizes, rollup.estimated_sizes(fact, dims, candidates), views, count, complete)
        stale = [name for name in before.tables if name.startswith(DERIVED)]
        built: dict[str, versions.Table | None] = dict.fromkeys(stale)
        for v in sorted(chosen, key=lambda v: -len(rollup.columns_of(v))):
            draft = versions.Version(0, {**before.tables, **{n: t for n, t in built.items() if t is not None}})
            rows = _answer(spark, root, draft, v, sizes, complete, dims)
            built[rollup_name(v)] = versions.write(rows, root, rollup_name(v))
            sizes[v] = versions.read(spark, root, versions.Version(0, built), rollup_name(v)).count()
        listed = [(list(v), n, sorted(complete)) for v, n in sizes.items()]
        table = spark.createDataFrame(listed, "niveis array<string>, linhas bigint, completas array<string>")
        built[CATALOGUE] = versions.write(table.coalesce(1), root, CATALOGUE)
        versions.publish(spark, root, before, built)
    return chosen


def _answer(
    spark: SparkSession,
    root: str,
    version: versions.Version,
    wanted: rollup.View,
    sizes: Mapping[rollup.View, int],
    complete: Collection[str],
    dims: Mapping[str, DataFrame],
) -> DataFrame:
    source = rollup.smallest(sizes, wanted, complete)
    if rollup_name(source) in version.tables:
        rows = versions.read(spark, root, version, rollup_name(source))
    else:
        rows = rollup.grouping(_exact_fact(spark, root, version), source)
    return rollup.rolled_up(rows, source, wanted, dims)


def roll_up(spark: SparkSession, out: str, levels: Sequence[str], measures: cube.Measures = cube.Measures()) -> DataFrame:
    """Quantity, value and profit by any levels, rounded once, from the smallest stored view that can give them."""
    root = warehouse_root(out)
    version = versions.current(spark, root)
    sizes, complete = stored_views(spark, out, version)
    wanted = rollup.view(levels)
    rows = _answer(spark, root, version, wanted, sizes, complete, _dims(spark, root, version))
    return rows.select(
        *rollup.columns_of(wanted),
        F.col("quantidade").cast(measures.quantity),
        *[F.col(c).cast(measures.money) for c in ("valor", "lucro")],
    )
