"""Statistics of the stored fact, kept per file and renewed for new files only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.functions.sizing import small_side
from quintacube.operators import sketches
from quintacube.sources import versions


def _computed(spark: SparkSession, root: str, version: versions.Version, name: str, files: list[str]) -> DataFrame:
    rows = versions.read(spark, root, version, name, files)
    return sketches.file_statistics(rows.withColumn("arquivo", F.regexp_extract("_metadata.file_path", f"/{name}/(v=[^/]+/.*)$", 1)))


def of_files(spark: SparkSession, root: str, version: versions.Version, name: str, table: str) -> DataFrame:
    """A row a file and column for the files that the version lists, and no others.

    Rows in `table` are used as they are; only files without any are read.
    """
    files = versions.files(versions.read(spark, root, version, name), name)
    if table not in version.tables:
        return _computed(spark, root, version, name, files)
    stored = versions.read(spark, root, version, table)
    known = {r["arquivo"] for r in stored.select("arquivo").distinct().collect()}  # files, as many as a version lists
    listed = spark.createDataFrame([(f,) for f in files], "arquivo string")
    kept = stored.join(small_side(listed), "arquivo", "left_semi").select(*stored.columns)
    new = sorted(set(files) - known)
    return kept.unionByName(_computed(spark, root, version, name, new)) if new else kept


def refreshed(spark: SparkSession, root: str, version: versions.Version, name: str, table: str) -> versions.Table:
    """The statistics of a version's files, written."""
    rows = of_files(spark, root, version, name, table)
    return versions.write(rows.coalesce(8), root, table)


def summary(
    spark: SparkSession,
    root: str,
    name: str,
    table: str,
    by: Sequence[str] = ("gid",),
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """Rows, NULLs, bounds, distinct values and quantiles of every column, by grouping or as a whole."""
    version = versions.current(spark, root)
    return sketches.merged(of_files(spark, root, version, name, table), by, quantiles)
