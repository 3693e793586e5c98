"""Versions of a set of Parquet tables below one folder, switched in one step.

A table consists of folders and files named by its version; new ones are written beside the old and
nothing is changed in place. A version is one small JSON file that lists what every table consists of.
It gets its number by a rename, so it is there whole or not at all, and the highest number is current:
whoever reads sees all tables as of one version, whatever is written or published meanwhile.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quintacube.sources.files import _store, read_text
from quintacube.sources.tables import save_table

_FOLDER = "_versions"


class Superseded(RuntimeError):
    """Another version was published since the one that a load began with."""


@dataclass(frozen=True)
class Table:
    """Folders and files of a table, relative to its own folder, and its schema."""

    paths: tuple[str, ...]
    schema: T.StructType


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: Mapping[str, Table] = field(default_factory=dict)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    store, folder = _store(spark, f"{root}/{_FOLDER}")
    if not store.exists(folder):
        return []
    names = [str(s.getPath().getName()) for s in store.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def _load(spark: SparkSession, root: str, number: int) -> Version:
    held = json.loads(read_text(spark, f"{root}/{_FOLDER}/{number:010d}.json"))
    return Version(number, {name: Table(tuple(t["paths"]), T.StructType.fromJson(t["schema"])) for name, t in held.items()})


def current(spark: SparkSession, root: str) -> Version:
    """The newest version; number 0 and no tables if there is none."""
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else Version()


def publish(spark: SparkSession, root: str, base: Version, tables: Mapping[str, Table | None]) -> Version:
    """Make the tables the version after `base`; those not given stay as they are there, None takes one out."""
    if (_numbers(spark, root) or [0])[-1] != base.number:
        raise Superseded(f"version {base.number} is not the newest any more")
    version = Version(base.number + 1, {n: t for n, t in {**base.tables, **tables}.items() if t is not None})
    text = json.dumps({n: {"paths": t.paths, "schema": json.loads(t.schema.json())} for n, t in version.tables.items()})
    store, beside = _store(spark, f"{root}/{_FOLDER}/.{uuid.uuid4().hex}")
    _, path = _store(spark, f"{root}/{_FOLDER}/{version.number:010d}.json")
    stream = store.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if store.exists(path) or not store.rename(beside, path):
        store.delete(beside, False)
        raise Superseded(f"version {version.number} exists already")
    return version


def write(rows: DataFrame, root: str, name: str, partition_by: str | None = None) -> Table:
    """Write rows to a folder of their own, which no version lists yet."""
    folder = f"v={uuid.uuid4().hex}"
    save_table(rows, f"{root}/{name}/{folder}", partition_by)
    return Table((folder,), T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]))


def read(spark: SparkSession, root: str, version: Version, name: str, paths: Iterable[str] | None = None) -> DataFrame:
    """A table, or some of its folders and files, as of a version."""
    table = version.tables[name]
    chosen = [f"{root}/{name}/{p}" for p in (table.paths if paths is None else paths)]
    if not chosen:
        return spark.createDataFrame([], table.schema)
    rows = spark.read.schema(table.schema).option("basePath", f"{root}/{name}").parquet(*chosen)
    return rows.select(*table.schema.names)


def located(spark: SparkSession, root: str, version: Version, name: str) -> DataFrame:
    """A table with the file of each row in a column `file_path`."""
    return read(spark, root, version, name).select("*", F.col("_metadata.file_path").alias("file_path"))


def _relative(name: str, uri: str) -> str:
    return "v=" + uri.rsplit(f"/{name}/v=", 1)[1]


def files(rows: DataFrame, name: str) -> list[str]:
    """All files of a table that was read, relative to its folder."""
    return sorted(_relative(name, uri) for uri in rows.inputFiles())


def files_of(hits: DataFrame, name: str) -> list[str]:
    """The files that some `located` rows come from; as many as a version lists, never one a row."""
    return sorted(_relative(name, r["file_path"]) for r in hits.select("file_path").distinct().collect())


def replaced(spark: SparkSession, root: str, version: Version, name: str, gone: list[str], new: Table | None) -> Table:
    """A table without some of its files and with those of `new`; its other files keep their names."""
    old = version.tables[name]
    kept = old.paths if not gone else sorted(set(files(read(spark, root, version, name), name)) - set(gone))
    return Table((*kept, *(new.paths if new else ())), old.schema)


def expire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete versions but the newest `keep`, and every folder that none of those lists."""
    numbers = _numbers(spark, root)
    for number in numbers[:-keep]:
        store, path = _store(spark, f"{root}/{_FOLDER}/{number:010d}.json")
        store.delete(path, False)
    held: dict[str, set[str]] = {}
    for number in numbers[-keep:]:
        for name, table in _load(spark, root, number).tables.items():
            held.setdefault(name, set()).update(p.split("/")[0] for p in table.paths)
    store, folder = _store(spark, root)
    if not store.exists(folder):
        return
    for table in store.listStatus(folder):
        name = str(table.getPath().getName())
        if not table.isDirectory() or name.startswith(("_", ".")):
            continue
        for part in store.listStatus(table.getPath()):
            label = str(part.getPath().getName())
            if label.startswith("v=") and label not in held.get(name, ()):
                store.delete(part.getPath(), True)
