"""Mixing sources to target weights by Sainte-Laguë apportionment.

The corpus is dealt by a hash of id, text and source, for rows that repeat also of all they hold and
of their number among their equals, into shards of about `SHARD_WORDS` words. In each shard every source stands for its share of its target, and equal blocks of `BLOCK_WORDS` words go
to the highest quotients share / (2k + 1): integer quotas per shard and source. Then blocks are
selected: the documents of a cell (shard, source) lie end to end in a seeded order, whole passes are
taken first, and the rest of the quota is a run of blocks from a seeded place, around the end.

Null source: a source of its own, after all others. Null or empty text: size 0, nothing taken.
Repeated rows are rows of their own; as equal rows differ by their number only, the mix depends on
what the rows hold and not on where they are stored. An empty table gives no rows. The sources are listed on the
driver, one row each, as the weights are. Nothing else leaves the executors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.llm.places import content, numbered_among_equals, placed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3
BLOCK_WORDS = 8
SHARD_WORDS = 1 << 17
SEED = 17


def fill_targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST_PASSES) -> list[float]:
    """Share all of `sizes` by weight; no target passes `most` times its source's size."""
    targets, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        each = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if each * weights[i] >= most * sizes[i]}
        for i in full or open_:
            targets[i] = float(most * sizes[i]) if full else each * weights[i]
        if not full:
            break
        left -= sum(targets[i] for i in full)
        open_ -= full
    return targets


def apportion(votes: np.ndarray, most: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Laguë: `seats` to the highest quotients votes / (2k + 1), at most `most` each."""
    seats = min(seats, int(most[votes > 0].sum()))
    got = np.zeros(len(votes), np.int64)
    if seats <= 0:
        return got
    got = np.minimum(np.floor(votes * (seats / votes.sum()) + 0.5).astype(np.int64), most)
    if got.sum() > seats:
        last = [(votes[i] / (2 * got[i] - 1), -i) for i in range(len(votes)) if got[i]]
        heapq.heapify(last)
        while got.sum() > seats:
            i = -heapq.heappop(last)[1]
            got[i] -= 1
            if got[i]:
                heapq.heappush(last, (votes[i] / (2 * got[i] - 1), -i))
    need = seats - int(got.sum())
    following = [(-votes[i] / (2 * got[i] + 1), i) for i in range(len(votes)) if got[i] < most[i] and votes[i] > 0]
    heapq.heapify(following)
    for _ in range(need):
        i = heapq.heappop(following)[1]
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(following, (-votes[i] / (2 * got[i] + 1), i))
    return got


def _quotas(block: int):
    def of_shard(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("_source", kind="stable")
        blocks = -(-cells["_cell"].to_numpy() // block)
        votes = cells["_votes"].to_numpy()
        quota = apportion(votes, MOST_PASSES * blocks, round(votes.sum() / block))
        return cells.assign(_quota=quota)[["_shard", "_source", "_cell", "_quota"]]

    return of_shard


def _overlap(low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(high, F.col("_end")) - F.greatest(low, F.col("_start")))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Id, size, source_size, target and taken words of every row.

    `weights` repeat over the sources in code point order.
    """
    rows = placed(docs, list(dict.fromkeys([id_col, text, source])))
    return _mixed(rows, weights, id_col, text, source, block, shard_words, seed).drop("file", "at")


def _mixed(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The mix of placed rows, with their places."""
    spark = rows.sparkSession
    row = F.col("row")
    rows = cut(
        rows.select(
            "file",
            "at",
            F.xxhash64(F.lit(seed), row[id_col], row[text], row[source]).alias("_order"),
            content(rows).alias("_whole"),
            row[id_col].alias("doc_id"),
            # A prefix keeps null apart from every name.
            F.coalesce(F.concat(F.lit("="), row[source].cast("string")), F.lit("")).alias("_source"),
            F.coalesce(F.regexp_count(row[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    again = cut(rows.groupBy("_order").count().where("count > 1").select("_order"))
    if not again.isEmpty():  # rows that repeat are dealt apart by all they hold and by their number among equals
        numbers = cut(numbered_among_equals(rows.join(again.hint("merge"), "_order", "left_semi"), "_whole")).hint("merge")
        apart = F.when(F.col("nth").isNotNull(), F.xxhash64("_order", "_whole", "nth")).otherwise(F.col("_order"))
        rows = cut(rows.join(numbers, ["file", "at"], "left").withColumn("_order", apart).drop("nth"))
    found = rows.groupBy("_source").agg(F.sum("size").alias("n")).collect()
    found.sort(key=lambda r: (r["_source"] == "", r["_source"].encode()))
    sizes = [r["n"] for r in found]
    targets = fill_targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    listed = F.broadcast(
        spark.createDataFrame(
            [(r["_source"], r["n"], t) for r, t in zip(found, targets, strict=True)],
            "_source string, source_size long, target double",
        )
    )
    shards = max(1, math.ceil(sum(sizes) / shard_words))
    dealt = rows.withColumn(
        "_shard", F.pmod(F.xxhash64(F.lit(seed + 1), "_order"), F.lit(shards))
    )
    share = F.when(F.col("source_size") > 0, F.col("target") * F.col("_cell") / F.col("source_size"))
    quotas = (
        dealt.groupBy("_shard", "_source")
        .agg(F.sum("size").alias("_cell"))
        .join(listed, "_source")
        .withColumn("_votes", F.coalesce(share, F.lit(0.0)))
        .groupBy("_shard")
        .applyInPandas(_quotas(block), "_shard long, _source string, _cell long, _quota long")
    )
    line = Window.partitionBy("_shard", "_source").orderBy("_order", "doc_id", "size", "file", "at")
    n = F.col("_blocks")
    first, rest = F.col("_first"), F.col("_quota") % n
    line_up = (
        dealt.repartition("_shard")
        .withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_start", F.col("_end") - F.col("size"))
        .join(quotas, ["_shard", "_source"])
        .join(listed, "_source")
        .withColumn("_blocks", F.greatest(F.lit(1), F.ceil(F.col("_cell") / block)))
        .withColumn("_first", F.pmod(F.xxhash64(F.lit(seed + 2), "_shard", "_source"), n))
    )
    extra = _overlap(first * block, (first + rest) * block) + _overlap(
        F.lit(0), F.greatest(F.lit(0), first + rest - n) * block
    )
    taken = (F.floor(F.col("_quota") / n) * F.col("size") + extra).cast("long")
    return line_up.select("file", "at", "doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Documents in the mix's proportions: each is repeated by its passes, a part from one half up
    counting as a pass. Input columns stay as they are; copies belong to rows, whatever their ids."""
    rows = placed(docs)
    copies = _mixed(rows, **options).select(
        "file",
        "at",
        F.expr("CASE WHEN size > 0 THEN CAST(round(taken / size) AS int) ELSE 0 END").alias("copies"),
    )
    return (
        # The copies grow with the documents: merged with them at every size, never broadcast.
        rows.join(cut(copies.where("copies > 0")).hint("merge"), ["file", "at"])
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("row.*")
    )
