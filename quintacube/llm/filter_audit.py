"""Audit of how filters interact: what each one removes in every order in which they may run.

Every document gets a mask of the filters it fails. Masks are counted by part and label in Spark, so
that what is left of a part is a table of 32 masks by 4 labels. Its audit is matrix work:

- F[mask, filter] is 0 where a mask fails the filter and infinite elsewhere;
- P[filter, order] is the step at which an order runs the filter, the order's inverse permutation;
- the min-plus product R = F * P, R[mask, order] = min over filters of F + P, is the step that removes a
  mask's documents in an order, infinite if none does.

Counts are then scattered to (order, R), weighted by documents, good documents or toxic ones; a filter's
redundant removals are the documents that fail it at a later step than their R.

Texts are compared across the whole table by their SHA-256. First the rows of one id and text are
combined, then those of a text, part and label into their smallest id and its count, and only these
small rows are compared with the smallest id of the text. So a text that a third of all rows share
is never gathered, nor joined with itself.

Null text: empty. Null or missing lang: the part ''. A null id has no labels, is no smaller than any id
and no id is smaller than it, so it neither fails E nor makes another fail. A repeated id is not smaller
than itself. An id with several label rows is good (toxic) if any of them says so. Extra columns are
ignored. An empty table gives no rows; without labels, nothing is lost that was good or toxic.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3
UPPER, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def mask_of_text(text: str) -> int:
    """Filters A to D that a text fails; bytes.split parts at the six ASCII white-space characters."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    upper = len(data) - len(data.translate(None, UPPER))
    mask = BIT["A"] * (len(words) < MIN_WORDS)
    mask |= BIT["B"] * (100 * len(set(words)) < MIN_DISTINCT * len(words))
    mask |= BIT["C"] * (100 * upper > MAX_UPPER * len(text))
    return mask | BIT["D"] * (len(data.translate(None, SYMBOLS)) < len(data))


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, texts = [], []
        for cell in batch.column(2):
            text = cell.as_py() or ""
            masks.append(mask_of_text(text))
            texts.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest())
        columns = [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(texts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "body"])


def marked(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """doc_id, part, the mask of filters A to D and the text's digest of every row."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("string").alias("text"),
    )
    return rows.mapInArrow(_mark, "doc_id long, part string, mask int, body binary")


def _label(labels: DataFrame, id_col: str) -> DataFrame:
    says = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(to) for c, to in (("quality", "good"), ("toxic", "bad"))]
    return labels.select(F.col(id_col).cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(*says)


def mask_counts(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """part, mask (all five filters), good, bad and n, from `marked` rows and labels."""
    nameless = rows.where("doc_id IS NULL").groupBy("part", "mask").agg(F.count("*").alias("n"))
    nameless = nameless.select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("bad"), "n")
    # Rows that repeat an id and a text are one row before any id meets its label.
    named = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "body", "part", "mask").agg(F.count("*").alias("n"))
    # Written, so that a hot id's rows come from their own shuffle and adaptive execution can split them.
    known = cut(
        cut(named)
        .join(cut(_label(labels, id_col)).hint("merge"), "doc_id", "left")
        .select("doc_id", "body", "part", "mask", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "bad")])
    )
    group = ["body", "part", "mask", "good", "bad"]
    by_id = known.groupBy("doc_id", *group).agg(F.sum("n").alias("n"))
    texts = by_id.groupBy(*group).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    earliest = F.min("first.doc_id").over(Window.partitionBy("body"))
    judged = texts.withColumn("stay", F.when(F.col("first.doc_id") == earliest, F.col("first.n")).otherwise(F.lit(0)))
    copies = F.struct((F.col("mask") + BIT["E"]).alias("mask"), (F.col("n") - F.col("stay")).alias("n"))
    alone = F.struct(F.col("mask"), F.col("stay").alias("n"))
    split = judged.select("part", "good", "bad", F.inline(F.array(copies, alone))).where("n > 0")
    every = split.select("part", "mask", "good", "bad", "n").unionByName(nameless)
    return every.groupBy("part", "mask", "good", "bad").agg(F.sum("n").alias("n"))


def orders(n: int = len(FILTERS)) -> np.ndarray:
    """All orders of filters, one a row, in the order of their names."""
    return np.array(list(permutations(range(n))))


def removal_steps(chosen: np.ndarray) -> np.ndarray:
    """R[mask, order]: the step from 1 on that removes a mask's documents, n + 1 if none does."""
    n = chosen.shape[1]
    failing = np.where(np.arange(1 << n)[:, None] >> np.arange(n) & 1, 0.0, np.inf)
    steps = np.empty_like(chosen.T, float)  # inverse permutations: filter by order
    np.put_along_axis(steps, chosen.T, np.arange(1.0, n + 1)[:, None], axis=0)
    product = (failing[:, :, None] + steps[None]).min(axis=1)
    return np.where(np.isinf(product), n + 1, product).astype(np.int64)


def audit(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> pd.DataFrame:
    """All orders and steps of one part, from its documents per mask: all, good and toxic ones."""
    chosen = orders()
    n, masks = chosen.shape[1], len(counts)
    removal = removal_steps(chosen)
    order_of = np.broadcast_to(np.arange(len(chosen)), removal.shape)

    def scattered(weights: np.ndarray) -> np.ndarray:
        out = np.zeros((len(chosen), n + 2), np.int64)
        np.add.at(out, (order_of, removal), np.broadcast_to(weights[:, None], removal.shape))
        return out[:, 1 : n + 1]

    removed = scattered(counts)
    fails = (np.arange(masks)[:, None] >> np.arange(n) & 1).astype(np.int64)
    failing = counts @ fails  # documents per filter, removed earlier or not
    only = counts[1 << np.arange(n)]
    shapley = np.zeros(n, np.int64)
    np.add.at(shapley, chosen, removed)
    names = np.array(list(FILTERS))
    return pd.DataFrame(
        {
            "filter_order": np.repeat(["".join(names[o]) for o in chosen], n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(chosen)),
            "kept": (counts.sum() - np.cumsum(removed, axis=1)).ravel(),
            "removed": removed.ravel(),
            "redundant": (failing[chosen] - removed).ravel(),
            "unique_fails": only[chosen].ravel(),
            "good_lost": scattered(good).ravel(),
            "toxic_lost": scattered(toxic).ravel(),
            "shapley": shapley[chosen].ravel(),
        }
    )


def _audit_part(cells: pd.DataFrame) -> pd.DataFrame:
    def per_mask(weights: pd.Series) -> np.ndarray:
        out = np.zeros(1 << len(FILTERS), np.int64)
        np.add.at(out, cells["mask"].to_numpy(), weights.to_numpy(np.int64))
        return out

    found = audit(per_mask(cells["n"]), per_mask(cells["n"] * cells["good"]), per_mask(cells["n"] * cells["bad"]))
    found.insert(0, "part", cells["part"].iloc[0])
    return found


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """One row per part, order of the filters and step; see the module for the columns' meaning."""
    counts = mask_counts(cut(marked(docs, id_col, text, part)), labels, id_col)
    # A part has at most 128 rows here, whatever the size of the table.
    result = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    return counts.groupBy("part").applyInPandas(_audit_part, result)


def oracle_sql() -> str:
    """The query in DuckDB SQL: every order played through on counts of masks."""
    listed = ", ".join(f"('{''.join(o)}')" for o in permutations(FILTERS))
    word = r"[^\x20\x09-\x0D]+"
    bits = " + ".join(f"{bit} * (f{name})::INT" for name, bit in BIT.items())
    return f"""
    WITH d AS (SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS t,
                      regexp_extract_all(COALESCE(text, ''), '{word}') AS w FROM documents),
    l AS (SELECT doc_id, bool_or(quality IS NOT NULL AND quality = 1) AS good,
                 bool_or(toxic IS NOT NULL AND toxic = 1) AS bad FROM labels GROUP BY doc_id),
    f AS (SELECT d.doc_id, part, COALESCE(good, false) AS good, COALESCE(bad, false) AS bad,
                 len(w) < {MIN_WORDS} AS fA, 100 * len(list_distinct(w)) < {MIN_DISTINCT} * len(w) AS fB,
                 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_UPPER} * length(t) AS fC,
                 regexp_matches(t, '[#$%&*|]') AS fD,
                 COALESCE(d.doc_id > MIN(d.doc_id) OVER (PARTITION BY t), false) AS fE
          FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
    m AS (SELECT part, {bits} AS mask, COUNT(*) AS n, COUNT(*) FILTER (good) AS g, COUNT(*) FILTER (bad) AS b
          FROM f GROUP BY part, mask),
    o AS (SELECT v.o AS filter_order, s.s AS step, substr(v.o, s.s::INT, 1) AS name
          FROM (VALUES {listed}) AS v(o), range(1, 6) AS s(s)),
    p AS (SELECT o.*, 1 << (instr('{FILTERS}', name) - 1)::INT AS bit,
                 list_sum([1 << (instr('{FILTERS}', c) - 1)::INT FOR c IN string_split(substr(filter_order, 1, (step - 1)::INT), '')
                           IF c <> '']) AS earlier FROM o),
    q AS (SELECT part, filter_order, step, name,
                 SUM(n) FILTER (mask & (bit | COALESCE(earlier, 0)::INT) = 0) AS kept,
                 SUM(n) FILTER (mask & bit <> 0 AND mask & COALESCE(earlier, 0)::INT = 0) AS removed,
                 SUM(n) FILTER (mask & bit <> 0 AND mask & COALESCE(earlier, 0)::INT <> 0) AS redundant,
                 SUM(n) FILTER (mask = bit) AS unique_fails,
                 SUM(g) FILTER (mask & bit <> 0 AND mask & COALESCE(earlier, 0)::INT = 0) AS good_lost,
                 SUM(b) FILTER (mask & bit <> 0 AND mask & COALESCE(earlier, 0)::INT = 0) AS toxic_lost
          FROM p, m GROUP BY part, filter_order, step, name)
    SELECT part, filter_order, step::INT AS step, COALESCE(kept, 0)::BIGINT AS kept, COALESCE(removed, 0)::BIGINT AS removed,
           COALESCE(redundant, 0)::BIGINT AS redundant, COALESCE(unique_fails, 0)::BIGINT AS unique_fails,
           COALESCE(good_lost, 0)::BIGINT AS good_lost, COALESCE(toxic_lost, 0)::BIGINT AS toxic_lost,
           COALESCE(SUM(removed) OVER (PARTITION BY part, name), 0)::BIGINT AS shapley
    FROM q"""
