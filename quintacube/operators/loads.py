"""Loading rules of the warehouse: insert-ignore, upsert and delete by predicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quintacube.operators.cube import KEYS


def insert_ignore(
    target: DataFrame, source: DataFrame, key: str | Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Target plus the source rows whose key it lacks; of several new rows the first in `order`."""
    keys = [key] if isinstance(key, str) else list(key)
    ranked = Window.partitionBy(*keys).orderBy(*order)
    new = (
        source.withColumn("_rank", F.row_number().over(ranked))
        .where("_rank = 1")
        .drop("_rank")
        .join(target.select(*keys), keys, "left_anti")
    )
    return target.unionByName(new.select(*target.columns))


def upsert_fact(target: DataFrame, source: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Source rows replace target rows of the same key; the other target rows stay."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left by a DELETE: those for which the condition is false or unknown."""
    return df.where(~F.coalesce(condition, F.lit(False)))
