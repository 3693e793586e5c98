"""Layout of cube rows along a space-filling curve over their keys.

Within a grouping, rows are ordered by the interleaved bits of all their keys. A range of any one key
then falls into few stretches of the curve, so the Parquet statistics of files, row groups and pages
rule out most of a grouping for a range of days as well as for one client or product. A sort
by one key after the other would do so for the first key only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quintacube.functions.expressions import ALL
from quintacube.functions.sizing import cut, is_read, size_in_bytes
from quintacube.operators.cube import KEYS

#: Bits of each key on the curve: five keys fit a long.
BITS = 12
#: Bytes of input that go to one file.
FILE_BYTES = 64 << 20


def _position(key: str) -> Column:
    """The key as a number with even steps; days are kept as yyyymmdd, which jumps at month ends."""
    if key != "idData":
        return F.col(key).cast("double")
    return F.expr("(idData div 10000) * 372D + (idData div 100 % 100) * 31 + idData % 100")


def key_ranges(rows: DataFrame) -> dict[str, tuple[float, float]]:
    """Smallest and greatest position of each key that is used, "all" left out; one row to the driver."""
    used = {k: F.when(F.col(k) != ALL, _position(k)) for k in KEYS}
    found = rows.agg(*[f(v).alias(f"{n}_{k}") for k, v in used.items() for n, f in (("min", F.min), ("max", F.max))]).first()
    return {k: (found[f"min_{k}"], found[f"max_{k}"]) for k in KEYS if found[f"min_{k}"] is not None}


def curve(ranges: dict[str, tuple[float, float]]) -> Column:
    """Place on the curve. A key rolled up in a grouping is the same in all its rows and does not count."""
    place = F.lit(0).cast("bigint")
    for j, key in enumerate(k for k in KEYS if k in ranges):
        low, high = ranges[key]
        cell = ((_position(key) - low) / (high - low + 1) * (1 << BITS)).cast("bigint")
        cell = F.when(F.col(key) == ALL, 0).otherwise(cell).cast("bigint")
        for i in range(BITS):
            bit = F.shiftright(cell, i).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.shiftleft(bit, i * len(KEYS) + j))
    return place


def clustered(rows: DataFrame) -> DataFrame:
    """Cube rows in range partitions along the curve, ready to be written by `gid`.

    Rows that are computed are written first: the ranges of the keys and the sample for the partitions
    would otherwise compute them three times. The keys themselves break ties, so a dense cell splits
    into as many partitions as it needs.
    """
    if not is_read(rows):
        rows = cut(rows)
    order = ["gid", "_curve", *KEYS]
    placed = rows.withColumn("_curve", curve(key_ranges(rows)))
    parts = max(1, -(-size_in_bytes(rows) // FILE_BYTES))
    return placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_curve")
