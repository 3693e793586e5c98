"""Lineage cuts by written tables, size-checked broadcast, and unions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.session import ensure_checkpoint_dir
from quintacube.sources.files import remove

#: Largest lookup, in bytes of its Parquet files, that is sent whole to every executor.
BROADCAST_BYTES = 32 << 20

_written: dict[str, list[str]] = {}


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's size; for columns read from a written table, the share of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_read(df: DataFrame) -> bool:
    """Whether the rows come from files with no more than columns picked and renamed."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.children().head()
    return plan.nodeName().startswith(("LogicalRelation", "Relation"))


def is_streamed(df: DataFrame) -> bool:
    """Whether the rows come from files one by one: picked, computed, copied, but not joined or summed."""

    def of(node) -> bool:
        children = [node.children().apply(i) for i in range(node.children().size())]
        if not children:
            return node.nodeName().startswith(("LogicalRelation", "Relation"))
        return node.nodeName() in ("Project", "Filter", "Generate", "Union") and all(map(of, children))

    return of(df._jdf.queryExecution().optimizedPlan())


def cut(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write the rows to a table in the session's checkpoint folder and go on from there.

    Unlike a checkpoint, the table can be read column by column and its size is known. `release`
    deletes what a session has written.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4()}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    # A third less disk than the default, for tables that are read once or twice.
    writer = df.write.option("compression", "zstd").option("parquet.writer.version", "v2")
    if partition_by is not None:
        writer = writer.option("maxConcurrentOutputFileWriters", "64").partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables that `cut` has written; results that still read them cannot be used."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what `cut` has written inside."""
    key = spark.sparkContext.applicationId
    outside, _written[key] = _written.get(key, []), []
    try:
        yield
    finally:
        release(spark)
        _written[key] = outside


def small_side(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a lookup for broadcast when its size on disk proves it small.

    A lookup that is computed is written first: estimates of joined or aggregated rows are far too
    high, and its size is then known without counting. One over the limit is left to the shuffle
    join; read from a file, it comes straight from its own shuffle, so adaptive execution can split
    a hot key of the other side.
    """
    if not is_read(lookup):
        lookup = cut(lookup)
    return F.broadcast(lookup) if size_in_bytes(lookup) <= max_bytes else lookup


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
