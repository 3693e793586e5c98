"""Sharding by extendible hashing, in DataFrame expressions only.

Every row has a 62-bit address: 32 bits of the key's MD5, then 30 bits of a hash of all it holds. The
directory is indexed by address prefixes. Only buckets over the byte limit are split on one more
bit, until each fits. Rows that repeat one key differ in the lower bits, and equal rows by their
number among each other, so a hot key is split like anything else, and the same way in every run.

Null or repeated keys and null or empty texts are ordinary rows (null text: no bytes). A single row
over the limit has a shard of its own, marked `oversized`. An empty table gives no rows. Columns of
the input are read by name; input columns called like an added one are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut, small_side, union_all
from quintacube.llm.places import content, numbered_among_equals, placed

ADDRESS_BITS, KEY_BITS = 62, 32
#: Bits examined beyond the ones that an even spread would need; deeper buckets take another round.
SPARE_BITS = 3
MOST_BITS_A_ROUND = 24
ADDED = ("shard", "depth", "bytes", "shard_bytes", "oversized")


def _bits(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _prefix(bits: int | Column) -> Column:
    bits = F.lit(bits) if isinstance(bits, int) else bits
    return F.call_function("shiftright", F.col("address"), (F.lit(ADDRESS_BITS) - bits).cast("int"))


def addressed(docs: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """`row` (the columns to keep), `bytes` and `address` of every row, written once."""
    low_bits = ADDRESS_BITS - KEY_BITS
    rows = placed(docs, list(dict.fromkeys([*keep, key, text])))
    row = F.col("row")
    high = _bits(F.coalesce(row[key].cast("string"), F.lit("")), 8)
    rows = cut(
        rows.select(
            F.struct(*[row[c].alias(c) for c in keep if c not in ADDED]).alias("row") if set(keep) - set(ADDED) else F.lit(None).alias("row"),
            F.coalesce(F.octet_length(row[text]), F.lit(0)).cast("long").alias("bytes"),
            (high * (1 << low_bits) + F.pmod(content(rows), F.lit(1 << low_bits))).alias("address"),
            "file",
            "at",
        )
    )
    again = cut(rows.groupBy("address").count().where("count > 1").select("address"))
    if not again.isEmpty():
        numbers = cut(numbered_among_equals(rows.join(again.hint("merge"), "address", "left_semi"), "address"))
        apart = F.pmod(F.xxhash64("address", "nth"), F.lit(1 << low_bits)) + F.shiftright("address", low_bits) * (1 << low_bits)
        address = F.when(F.col("nth") > 0, apart).otherwise(F.col("address"))
        rows = cut(rows.join(numbers.hint("merge"), ["file", "at"], "left").withColumn("address", address).drop("nth"))
    return rows.drop("file", "at")


def _round(rows: DataFrame, depth: int, bits: int, limit: int) -> DataFrame:
    """Per prefix of `depth + bits` bits: the first depth at which its bucket fits, or null."""
    deepest = depth + bits
    leaves = rows.groupBy(_prefix(deepest).alias("_leaf")).agg(
        F.sum("bytes").alias("_bytes"), F.count("*").alias("_rows")
    )
    leaves = cut(leaves)
    levels = leaves.select(
        "_leaf", "_bytes", "_rows", F.explode(F.sequence(F.lit(depth), F.lit(deepest))).alias("_depth")
    ).withColumn(
        "_bucket",
        F.call_function("shiftright", F.col("_leaf"), (F.lit(deepest) - F.col("_depth")).cast("int")),
    )
    buckets = levels.groupBy("_depth", "_bucket").agg(
        F.sum("_bytes").alias("shard_bytes"), F.sum("_rows").alias("_rows")
    )
    closed = buckets.where((F.col("shard_bytes") <= limit) | (F.col("_rows") == 1) | (F.col("_depth") == ADDRESS_BITS))
    fits = (
        levels.drop("_bytes", "_rows")
        .join(closed, ["_depth", "_bucket"])
        .groupBy("_leaf")
        .agg(F.min(F.struct("_depth", "shard_bytes", "_bucket")).alias("_fit"))
    )
    return cut(leaves.select("_leaf").join(fits, "_leaf", "left"))


def _kept(rows: DataFrame) -> list[str]:
    kind = rows.schema["row"].dataType
    return kind.fieldNames() if hasattr(kind, "fieldNames") else []


def assign(rows: DataFrame, limit: int) -> DataFrame:
    """Addressed rows with shard (its address prefix as a bit string), depth and sizes."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    bits = max(1, math.ceil(math.log2(max(1, total / limit))) + SPARE_BITS)
    bits = min(bits, MOST_BITS_A_ROUND)
    done, depth = [], 0
    while True:
        step = min(bits, ADDRESS_BITS - depth)
        directory = _round(rows, depth, step, limit)
        found = rows.withColumn("_leaf", _prefix(depth + step)).join(small_side(directory), "_leaf")
        done.append(
            found.where("_fit IS NOT NULL").select(
                *[F.col("row")[c].alias(c) for c in _kept(rows)],
                "bytes",
                F.expr("lpad(bin(_fit._bucket), _fit._depth, '0')").alias("shard"),
                F.col("_fit._depth").cast("int").alias("depth"),
                F.col("_fit.shard_bytes").alias("shard_bytes"),
                (F.col("_fit.shard_bytes") > limit).alias("oversized"),
            )
        )
        if directory.where("_fit IS NULL").isEmpty():
            return union_all(done)
        depth += step
        rows = cut(found.where("_fit IS NULL").drop("_leaf", "_fit"))


def shard_documents(
    docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` (all by default) of every row, with its shard of at most `limit` bytes."""
    return assign(addressed(docs, key, text, docs.columns if keep is None else keep), limit)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard; each shard's rows meet in one task, which its limit bounds."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)


def oracle_sql(limit: int) -> str:
    """The same shards of distinct keys in DuckDB SQL: every depth up to 32 for every row."""
    return f"""
    WITH r AS (
      SELECT doc_id, COALESCE(strlen(text), 0)::BIGINT AS bytes,
             ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT AS h
      FROM documents),
    l AS (SELECT r.*, d, (h >> (32 - d)) AS b FROM r, range(0, 33) t(d)),
    s AS (SELECT d, b, SUM(bytes)::BIGINT AS shard_bytes, COUNT(*) AS n FROM l GROUP BY d, b),
    f AS (
      SELECT l.doc_id, l.bytes, l.d, l.b, s.shard_bytes,
             ROW_NUMBER() OVER (PARTITION BY l.doc_id ORDER BY l.d) AS k
      FROM l JOIN s ON l.d = s.d AND l.b = s.b WHERE s.shard_bytes <= {limit} OR s.n = 1)
    SELECT doc_id, bytes, CASE WHEN d = 0 THEN '' ELSE lpad(bin(b), d::INTEGER, '0') END AS shard,
           d::INTEGER AS depth, shard_bytes, shard_bytes > {limit} AS oversized
    FROM f WHERE k = 1"""
