"""Rows addressed by where they are stored: the same in every read, however the input is split.

The addressed rows hold the input's columns inside one struct, `row`, so no name of theirs can clash
with one that is added beside it; `row.*` gives them back.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut

#: Rows of a file that are numbered together among their equals.
NUMBERED_ROWS = 1 << 14


def _numbered(docs: DataFrame) -> bool:
    """Whether the rows are a plain table read whose reader numbers the rows of a file."""
    if "_metadata" in docs.columns or docs._jdf.queryExecution().analyzed().children().nonEmpty() or not docs.inputFiles():
        return False
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def _quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{n.replace('`', '``')}`") for n in names]


def placed(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """`row` (a struct of `columns`, all by default), `file` (a hash of the file's path) and `at` (the row's number in it).

    Anything but a plain table read is written first.
    """
    row = F.struct(*_quoted(columns or docs.columns)).alias("row")
    if not _numbered(docs):
        docs, row = cut(docs.select(row)), F.col("row")
    return docs.select(row, F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


def content(rows: DataFrame) -> Column:
    """A hash of all that a placed row holds, apart from maps, which have no order."""
    fields = rows.schema["row"].dataType.fields
    return F.xxhash64(F.lit(1), *[F.col("row")[f.name] for f in fields if "map<" not in f.dataType.simpleString()])


def numbered_among_equals(rows: DataFrame, key: str) -> DataFrame:
    """file, at and `nth`: 0, 1, 2, ... over the rows that share a value of `key`.

    A value's rows are numbered block by block of the files, so no task gets all of them.
    """
    blocks = rows.select(key, "file", F.floor(F.col("at") / NUMBERED_ROWS).alias("block"), "at")
    sizes = blocks.groupBy(key, "file", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    begins = cut(sizes.select(key, "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")))
    inside = F.row_number().over(Window.partitionBy(key, "file", "block").orderBy("at")) - 1
    return (
        blocks.withColumn("inside", inside)
        .join(begins.hint("merge"), [key, "file", "block"])
        .select("file", "at", (F.col("begin") + F.col("inside")).alias("nth"))
    )
