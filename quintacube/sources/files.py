"""Deleting, switching and gathering files on whatever file system a path belongs to."""

from __future__ import annotations

import json
import time
import uuid
from datetime import timedelta

from pyspark.sql import SparkSession

#: Files of at least this size are not gathered again.
GATHERED_BYTES = 32 << 20
_GATHERED = "_gathered"


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    store, where = _store(spark, path)
    store.delete(where, True)


def switch(spark: SparkSession, new: str, current: str) -> None:
    """Put a finished folder in the place of another; the old one goes only after the renames."""
    store, new_path = _store(spark, new)
    _, current_path = _store(spark, current)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{current}.old")
    store.delete(old, True)
    store.mkdirs(current_path.getParent())
    if store.exists(current_path) and not store.rename(current_path, old):
        raise OSError(f"cannot move {current} aside")
    if not store.rename(new_path, current_path):
        raise OSError(f"cannot move {new} to {current}")
    store.delete(old, True)
    spark.catalog.refreshByPath(current)


def read_text(spark: SparkSession, path: str) -> str:
    store, where = _store(spark, path)
    stream = store.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names(spark: SparkSession, folder: str, suffix: str) -> list[tuple[str, int]]:
    """Visible files of a folder with their sizes."""
    store, where = _store(spark, folder)
    if not store.exists(where):
        return []
    found = [(str(s.getPath().getName()), s.getLen()) for s in store.listStatus(where) if s.isFile()]
    return [(name, size) for name, size in found if name.endswith(suffix) and not name.startswith((".", "_"))]


def gather_files(spark: SparkSession, folder: str, ddl: str, grace: timedelta) -> int:
    """Write the rows of a Parquet folder's small files into one more file, and delete the small ones later.

    What has been gathered is listed in a file of its own, written after the rows; its entries are deleted
    by the first call after `grace`. Repeated rows count as one. Returns how many files wait to be deleted.
    """
    now, waiting = time.time(), 0
    lists = f"{folder}/{_GATHERED}"
    pending = set()
    for name, _ in _names(spark, lists, ".json"):
        held = json.loads(read_text(spark, f"{lists}/{name}"))
        pending |= set(held["files"])
        if held["at"] + grace.total_seconds() <= now:
            _delete_listed(spark, folder, lists, name, held["files"])
        else:
            waiting += len(held["files"])
    small = sorted(n for n, size in _names(spark, folder, ".parquet") if size < GATHERED_BYTES and n not in pending)
    if len(small) < 2:
        return waiting
    rows = spark.read.schema(ddl).parquet(*[f"{folder}/{n}" for n in small]).distinct()
    rows.coalesce(1).write.mode("append").parquet(folder)
    store, beside = _store(spark, f"{lists}/.{uuid.uuid4().hex}")
    name = f"{uuid.uuid4().hex}.json"
    stream = store.create(beside, False)
    stream.write(bytearray(json.dumps({"at": now, "files": small}).encode()))
    stream.close()
    store.rename(beside, _store(spark, f"{lists}/{name}")[1])
    if grace.total_seconds() <= 0:
        _delete_listed(spark, folder, lists, name, small)
        return waiting
    return waiting + len(small)


def _delete_listed(spark: SparkSession, folder: str, lists: str, name: str, files: list[str]) -> None:
    for file in files:
        remove(spark, f"{folder}/{file}")
    remove(spark, f"{lists}/{name}")
    spark.catalog.refreshByPath(folder)
