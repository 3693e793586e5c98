"""SimHash near-duplicates by multi-index hashing.

A fingerprint holds, bit by bit, the majority of the XXH64 values of a text's word shingles. Two
fingerprints within `RADIUS` bits agree closely on some segment of their bits: small Hamming balls
within each segment are enumerated, looked up in a table of the segments' values, and whole
distances verified. Equal fingerprints are one entry of the table.

A segment value that more than `DENSE` different fingerprints share is not looked up. All
fingerprints near such a value enumerate the ball of half the radius instead: two of them have a
common point exactly if they are within the radius, and each point links its fingerprints to their
smallest. This loses no link, makes no wrong one, and grows with the group's size, not its square.

Null and empty texts have fingerprint zero and link like others. A null id gets the smallest id of
its group, null if there is none. Repeated rows each have a result row. An empty table gives no
rows. Columns are read by name; others are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.llm import words
from quintacube.llm.components import components
from quintacube.llm.places import content, placed

SHINGLE, HASH_SEED, RADIUS, DENSE = 4, 42, 4, 64
#: Above so many fingerprints, two segments of 32 bits make fewer chance meetings than three of 21.
THREE_SEGMENTS_UP_TO = 1 << 25

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_hashes(data: bytes, width: int = SHINGLE) -> list[int]:
    """XXH64 of every run of `width` words, joined by spaces; of all words if there are fewer."""
    found = _WORD.findall(data.lower())  # of bytes: A-Z only
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= width:
        return [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.append(0, ends[: len(found) - width] + 1)
    digest, seed = xxhash.xxh64_intdigest, HASH_SEED
    return [digest(joined[s:e], seed) for s, e in zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)]


def majorities(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Majority of each bit over consecutive runs of `counts` values; zero for empty runs."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.cumsum(counts) - counts)[full], axis=0, dtype=np.int32)
        major = np.packbits(2 * ones > counts[full, None], axis=1, bitorder="little")
        out[full] = major.view(np.uint64)[:, 0]
    return out


def fingerprints(texts: list[str | None], width: int = SHINGLE) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    for first, held in words.chunks(texts):
        hashes = [shingle_hashes(data, width) for data in held]
        counts = np.fromiter(map(len, hashes), np.int64, len(held))
        flat = np.fromiter((h for some in hashes for h in some), np.uint64, int(counts.sum()))
        out[first : first + len(held)] = majorities(flat, counts)
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = fingerprints(batch.column(1).to_pylist()).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprint, "doc_id long, fp long")


def segments(n: int, radius: int = RADIUS, bits: int = 64) -> list[tuple[int, int, int]]:
    """(lowest bit, width, ball radius) of each of `n` segments.

    If every segment differed by more than its radius, the whole would differ by more than `radius`.
    """
    out, low = [], 0
    for i in range(n):
        width = bits // n + (i < bits % n)
        out.append((low, width, radius // n - (i > radius % n)))
        low += width
    return [s for s in out if s[2] >= 0]


def ball(width: int, radius: int) -> list[int]:
    """All masks of at most `radius` ones among `width` bits."""
    masks, last = [0], [(0, -1)]
    for _ in range(radius):
        last = [(m | 1 << b, b) for m, top in last for b in range(top + 1, width)]
        masks += [m for m, _ in last]
    return masks


def _signed(masks: list[int]) -> Column:
    return F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])


def _xor(value: Column, masks: list[int]) -> Column:
    return F.transform(_signed(masks), lambda m: value.bitwiseXOR(m))


def _keys(parts: list[tuple[int, int, int]], probe: bool) -> Column:
    """Segment number above the segment's value; for probes, every value in its ball."""
    each = []
    for i, (low, width, radius) in enumerate(parts):
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        each.append(_xor(value + F.lit(i << 40).cast("long"), ball(width, radius) if probe else [0]))
    return F.concat(*each)


def links(nodes: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """Pairs (a, b) of different fingerprints that connect all within `radius` bits of each other.

    `nodes` has a column fp without repeats and is read several times. Every pair is a true link;
    pairs that meet only at dense values may be linked through others.
    """
    n = nodes.count()
    parts = segments(3 if n <= THREE_SEGMENTS_UP_TO else 2, radius)
    entries = nodes.select("fp", F.explode(_keys(parts, probe=False)).alias("key"))
    probes = nodes.select("fp", F.explode(_keys(parts, probe=True)).alias("key"))
    full = cut(entries.groupBy("key").count().where(F.col("count") > dense).select("key"))
    near = None
    if not full.isEmpty():
        full = full.hint("merge")  # like all that grows with the documents, never broadcast
        near = cut(probes.join(full, "key", "left_semi").select("fp").distinct())
        entries, probes = (x.join(full, "key", "left_anti") for x in (entries, probes))
    a, b = probes.select(F.col("fp").alias("a"), "key"), entries.select(F.col("fp").alias("b"), "key")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = a.join(b.hint("merge"), (a["key"] == b["key"]) & (F.col("a") != F.col("b")) & close).select("a", "b")
    if near is None:
        return pairs
    points = near.select("fp", F.explode(_xor(F.col("fp"), ball(64, radius // 2))).alias("at"))
    least = cut(points.groupBy("at").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return pairs.unionAll(points.join(least.hint("merge"), "at").where("fp <> b").select(F.col("fp").alias("a"), "b"))


def grouped(marked: DataFrame) -> DataFrame:
    """fp, root (the smallest fingerprint of its group) and component_id of every fingerprint of `marked` (doc_id, fp)."""
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp")))
    rooted = cut(
        nodes.join(roots.hint("merge"), F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    groups = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return cut(rooted.join(groups.hint("merge"), "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, fingerprint (16 hex digits) and component_id (smallest id of its group) of every row."""
    marked = cut(fingerprint_table(docs, id_col, text))
    return marked.join(grouped(marked).hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _fingerprint_placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array(fingerprints(batch.column(4).to_pylist()).view(np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], found], ["doc_id", "tie", "file", "at", "fp"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, all columns: the one with the smallest id.

    Rows without an id come after all others. Where ids repeat, the smallest hash of the whole row
    decides; rows that are equal in everything leave one.
    """
    rows = placed(docs)
    row = F.col("row")
    texts = rows.select(
        row[id_col].cast("long").alias("doc_id"), content(rows).alias("tie"), "file", "at", row[text].cast("string").alias("text")
    )
    marked = cut(texts.mapInArrow(_fingerprint_placed, "doc_id long, tie long, file long, at long, fp long"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie", "file", "at"))
    # What stays grows with the documents, so it is merged with them at every size, never broadcast.
    rooted = marked.join(grouped(marked).hint("merge"), "fp")
    stay = cut(rooted.groupBy("root").agg(first.alias("first")).select("first.file", "first.at"))
    return rows.join(stay.hint("merge"), ["file", "at"], "left_semi").select("row.*")
