"""Reading and writing tables: Parquet folders, JDBC sources, inline rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quintacube.functions.expressions import month_first_timestamp
from quintacube.sources.schemas import SOURCE_DDL


def read_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All source tables from Parquet folders below `root`, with their declared schemas."""
    return {
        name: spark.read.schema(ddl).parquet(f"{root}/{name}") for name, ddl in SOURCE_DDL.items()
    }


def jdbc_options(
    url: str, table: str, key: str, lower: int, upper: int, partitions: int
) -> dict[str, str]:
    """Options of a JDBC scan split into `partitions` ranges of an integer key."""
    if partitions < 1 or upper < lower:
        raise ValueError("need at least one partition and lower <= upper")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def read_jdbc(spark: SparkSession, **scan) -> DataFrame:
    """A source table straight from the transactional database, read by parallel range scans."""
    return spark.read.format("jdbc").options(**jdbc_options(**scan)).load()


def _cuts(values: list) -> list[tuple]:
    """Cut points in order, with how many of the equal shares end at each."""
    counted: dict = {}
    for v in values:
        counted[v] = counted.get(v, 0) + 1
    return sorted(counted.items())


def range_predicates(sample: DataFrame, key: str, partitions: int, second: str | None = None) -> list[str]:
    """Predicates that split a scan into ranges with about the same number of rows.

    The cut points are quantiles of an integer key in a sample of the table. A value that several quantiles fall
    on holds several shares; it gets ranges of its own, as many as it has shares if a `second` integer
    column tells its rows apart. The ranges are disjoint and hold every row, NULL keys included.
    """
    if partitions < 1:
        raise ValueError("need at least one partition")
    rows = sample.agg(F.count("*").alias("n"), F.count(key).alias("keyed")).first()
    unkeyed = rows["n"] - rows["keyed"]
    empty_shares = round(partitions * unkeyed / rows["n"]) if rows["n"] else 0
    steps = max(1, partitions - empty_shares)
    shares = [i / steps for i in range(1, steps)]
    found = sample.agg(F.percentile_approx(key, shares, 100_000).alias("cuts")).first()["cuts"] if shares else None

    def split(condition: str, times: int) -> list[str]:
        """A single value in as many ranges as it has shares."""
        if second is None or times < 2:
            return [condition]
        return [f"{condition} AND ({p})" for p in range_predicates(sample.where(condition), second, times)]

    ranges, above = [], f"{key} IS NOT NULL"
    for value, times in _cuts(found or []):
        ranges.append(f"{above} AND {key} < {value}")
        if times == 1:
            above = f"{key} >= {value}"
        else:
            ranges += split(f"{key} = {value}", times)
            above = f"{key} > {value}"
    ranges.append(above)
    if empty_shares:
        return ranges + split(f"{key} IS NULL", empty_shares)
    return [f"{ranges[0]} OR {key} IS NULL", *ranges[1:]]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, predicates: Sequence[str], **properties: str) -> DataFrame:
    """A source table from the transactional database, one task a predicate."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties={"fetchsize": "10000", **properties})


def inline_rows(
    spark: SparkSession, table: str, rows: Iterable[Sequence], serial: str | None = None
) -> DataFrame:
    """Typed DataFrame from literal rows of a source table.

    Timestamps are given as month-first text and decimals as text or numbers. `serial` names a
    column left out of the rows and numbered from 1 in row order.
    """
    schema = T.StructType.fromDDL(SOURCE_DDL[table])
    given = [f for f in schema.fields if f.name != serial]
    texty = (T.TimestampNTZType, T.DecimalType)
    plain = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, texty) else f.dataType)
            for f in given
        ]
    )
    values = [
        tuple(
            str(v) if v is not None and isinstance(f.dataType, texty) else v
            for f, v in zip(given, row, strict=True)
        )
        for row in rows
    ]
    if serial is not None:
        plain = T.StructType([T.StructField(serial, T.IntegerType()), *plain.fields])
        values = [(i, *row) for i, row in enumerate(values, start=1)]
    raw = spark.createDataFrame(values, plain)
    return raw.select(
        *[
            month_first_timestamp(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def save_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace the Parquet table at `path`; a table must not be overwritten by a plan reading it."""
    writer = df.write.mode("overwrite")
    if partition_by is not None:
        # One open writer per partition value instead of a sort of every task's rows.
        writer = writer.option("maxConcurrentOutputFileWriters", "64").partitionBy(partition_by)
    writer.parquet(path)
