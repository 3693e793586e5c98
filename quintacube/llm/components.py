"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut


#: Edges in one partition; many nearly empty tasks would take longer than their work.
EDGES_A_PARTITION = 200_000


def _star(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """Every node's larger (or smaller) neighbours are linked to its smallest neighbour instead.

    `edges` has each edge once, as a > b. Minima are written before they are joined, so that a hub's
    edges come straight from a shuffle and can be split.
    """
    seen = edges.unionAll(edges.select("b", "a")).toDF("u", "v") if large else edges.toDF("u", "v")
    least = cut(seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(parts))
    moved = seen.join(least.hint("merge"), "u").where("v > u" if large else "v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    moved = moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return cut(moved.distinct().coalesce(parts))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    `edges` has two columns of one ordered type; direction, repeats and loops do not matter.
    """
    a, b = edges.columns
    state = cut(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    before = None
    while True:
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            return state.toDF("node", "root")
        before = now
        parts = 1 + now[0] // EDGES_A_PARTITION
        state = _star(_star(state, True, parts), False, parts)
