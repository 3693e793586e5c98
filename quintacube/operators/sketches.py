"""Mergeable statistics of cube files: counts, bounds, distinct values and quantiles.

One row a file and column. Files never change, so their rows stay true for as long as the file is
listed; statistics of a grouping or of the whole fact are merged from them without reading the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quintacube.operators.cube import KEYS, MEASURES

#: Size of the sketches: distinct counts within 5 %, ranks of quantiles within 3 % (about three standard errors).
HLL_BITS, KLL_SIZE = 12, 200
BOUND = "decimal(38,8)"


def _counted(rows: DataFrame, column: str) -> Column:
    whole = isinstance(rows.schema[column].dataType, T.IntegralType)
    return F.col(column).cast("bigint" if whole else "string")


def file_statistics(rows: DataFrame, columns: Sequence[str] = (*KEYS, *MEASURES)) -> DataFrame:
    """One row a file and column, from rows with their file in `arquivo`.

    A file is read by few tasks, each of which sends one sketch a column, whatever the number of rows.
    """
    measured = [F.count("*").alias("linhas")]
    for c in columns:
        measured.append(
            F.struct(
                F.lit(c).alias("coluna"),
                F.count_if(F.col(c).isNull()).alias("nulos"),
                F.min(c).cast(BOUND).alias("menor"),
                F.max(c).cast(BOUND).alias("maior"),
                F.hll_sketch_agg(_counted(rows, c), HLL_BITS).alias("distintos"),
                F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_SIZE).alias("quantis"),
            ).alias(f"_{c}")
        )
    found = rows.groupBy("arquivo", "gid").agg(*measured)
    return found.select("arquivo", "gid", "linhas", F.inline(F.array(*[f"_{c}" for c in columns])))


def merged(statistics: DataFrame, by: Sequence[str] = ("gid",), quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Statistics of all files together, one row for each value of `by` and column.

    `distintos` and `quantis` are estimates; a column of NULLs has no quantiles.
    """
    found = statistics.groupBy(*by, "coluna").agg(
        F.sum("linhas").alias("linhas"),
        F.sum("nulos").alias("nulos"),
        F.min("menor").alias("menor"),
        F.max("maior").alias("maior"),
        F.hll_sketch_estimate(F.hll_union_agg("distintos")).alias("distintos"),
        F.kll_merge_agg_double("quantis").alias("_quantis"),
    )
    at = F.array(*[F.kll_sketch_get_quantile_double("_quantis", F.lit(float(q))) for q in quantiles])
    return found.withColumn("quantis", F.when(F.col("linhas") > F.col("nulos"), at)).drop("_quantis")
