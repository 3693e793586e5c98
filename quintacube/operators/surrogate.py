"""Dense surrogate ids over a unique business key, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quintacube.session import ensure_checkpoint_dir

_ROW_BITS = 33


def dense_ids(df: DataFrame, key: str, id_name: str) -> DataFrame:
    """Number the rows 1..n in order of `key`.

    The rows are range-partitioned and sorted on the key, then checkpointed so that the partitions
    are fixed. A row's id is its place in its partition plus the size of the partitions before it;
    only one count per partition is ranked, never the rows themselves.
    """
    ensure_checkpoint_dir(df.sparkSession)
    fixed = df.repartitionByRange(F.asc(key)).sortWithinPartitions(F.asc(key)).checkpoint()
    placed = fixed.withColumn("_place", F.monotonically_increasing_id()).select(
        "*",
        F.shiftright("_place", _ROW_BITS).alias("_part"),
        F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of `fixed`: bounded by the partition count, not by the data.
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_row") + 1).cast("bigint").alias(id_name), *df.columns
    )


def continued_ids(known: DataFrame, df: DataFrame, key: str, id_name: str) -> DataFrame:
    """The rows of `df` whose key `known` lacks, numbered on from its greatest id in order of `key`.

    `known` keeps its ids; `df` has each key once. With every load the ids stay dense: the first load
    numbers from 1, and a key that comes back later has the id that it always had.
    """
    new = df.join(known.select(key), key, "left_anti")
    last = known.agg(F.coalesce(F.greatest(F.max(id_name), F.lit(0)), F.lit(0)).alias("last")).scalar()
    return dense_ids(new, key, id_name).withColumn(id_name, (F.col(id_name) + last).cast("bigint")).select(id_name, *df.columns)
