"""Quality rules: exact rule statistics, and an isolation forest over ratios of them.

The forest is grown on labelled documents; one that few random splits isolate is unlike most. The
longest mean path that still counts as anomalous is calibrated on their labels. The forest tells rows
apart by whole steps of four shares, so all labelled rows, counted per combination of steps and label
in Spark, are one small table: there are at most 2 * (MOST_STEPS + 1)^2 * 36 combinations, however many
rows. Statistics and verdicts cover every row and the whole of every text.

Null and empty texts have statistics 0 and fail the base rules. Repeated rows are judged alike, each
with its own result row. Without labelled rows of both kinds the base rules alone decide. An empty
table gives no rows. Columns are read by name; others are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.llm import words

TREES, SAMPLE, SEED, STEP = 100, 256, 5, 0.2
#: Symbols and marks may outnumber words; from this many steps (ten a word) on they count alike.
MOST_STEPS = 50
MIN_WORDS, MOST_REPEATED_PERCENT = 50, 50

SYMBOLS = words.table(b"#*$%&|<>")
UPPER = words.table(range(0x41, 0x5B))
MARKS = words.table(b"!?")

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_marks")
STATS = BASE + EXTRA


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of STATS per text."""
    parts = []
    for _, held in words.chunks(texts):
        t = words.Texts(held)
        parts.append(
            np.stack(
                [
                    t.n_words,
                    t.per_text(words.WORD_CHAR),
                    t.per_text(SYMBOLS),
                    t.repeated_lines(),
                    t.repeated_words(),
                    *(t.per_text(which) for which in (UPPER, MARKS)),
                ],
                axis=1,
            )
        )
    return np.concatenate(parts) if parts else np.zeros((0, len(STATS)), np.int64)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = statistics(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(found[:, k]) for k in range(len(STATS)))], ["doc_id", *STATS]
        )


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{c} long" for c in STATS))


def ratios(stats: np.ndarray) -> np.ndarray:
    """Shares of symbols, repeated words, upper case and !? marks, in whole steps of `STEP`.

    Shares do not depend on a text's length. Steps keep random splits away from the small
    differences between ordinary texts.
    """
    s = dict(zip(STATS, stats.astype(np.float64).T, strict=True))
    n, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    shares = (s["n_symbols"] / n, s["n_repeat_words"] / n, s["n_upper"] / chars, s["n_marks"] / n)
    return np.minimum(np.floor(np.stack(shares, axis=1) / STEP), MOST_STEPS)


def _steps() -> list[Column]:
    """The same steps as expressions."""
    shares = (("n_symbols", "n_words"), ("n_repeat_words", "n_words"), ("n_upper", "word_chars"), ("n_marks", "n_words"))
    return [F.least(F.floor(F.col(a) / F.greatest(F.col(b), F.lit(1)) / STEP), F.lit(MOST_STEPS)).alias(f"s{k}") for k, (a, b) in enumerate(shares)]


def _average_path(n: np.ndarray | float) -> np.ndarray:
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), (n == 2) * 1.0)


class Forest:
    """Random trees over random draws of weighted rows; `path` is the mean number of splits that isolate a row."""

    def __init__(self, rows: np.ndarray, weights: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        drawn = int(min(sample, weights.sum()))
        self.height = int(np.ceil(np.log2(max(2, drawn))))
        size = (1 << (self.height + 1)) - 1
        self.feature = np.full((trees, size), -1, np.int32)
        self.split, self.length = np.zeros((trees, size)), np.zeros((trees, size))
        for t in range(trees):
            self._grow(t, 0, 0, np.repeat(rows, rng.multinomial(drawn, weights / weights.sum()), axis=0), rng)

    def _grow(self, t: int, node: int, depth: int, rows: np.ndarray, rng: np.random.Generator) -> None:
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth == self.height or len(rows) < 2 or not len(usable):
            self.length[t, node] = depth + _average_path(len(rows))
            return
        k = rng.choice(usable)
        cut_at = rng.uniform(low[k], high[k])
        self.feature[t, node], self.split[t, node] = k, cut_at
        left = rows[:, k] <= cut_at
        self._grow(t, 2 * node + 1, depth + 1, rows[left], rng)
        self._grow(t, 2 * node + 2, depth + 1, rows[~left], rng)

    def path(self, rows: np.ndarray) -> np.ndarray:
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, split, length in zip(self.feature, self.split, self.length, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.height):
                k = feature[node]
                right = rows[every, k] > split[node]
                node = np.where(k >= 0, 2 * node + 1 + right, node)
            total += length[node]
        return total / len(self.feature)


def calibrate(path: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The path length below which a row is dropped: fewest wrong verdicts on all labelled rows.

    `good` and `bad` count the rows of each path. Among equally good places the middle of the gap to
    the next longer path is taken.
    """
    order = np.argsort(path, kind="stable")
    path, gain = path[order], np.cumsum((bad - good)[order])
    ends = np.append(np.flatnonzero(np.diff(path) > 0), len(path) - 1)
    best = int(np.argmax(gain[ends]))
    at = path[ends[best]]
    following = path[ends[best] + 1] if ends[best] + 1 < len(path) else at + 1
    return float((at + following) / 2)


def fit(steps: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[Forest, float] | None:
    """Forest and threshold from distinct rows of steps and how many good and bad rows have them."""
    if not good.any() or not bad.any():
        return None
    forest = Forest(steps, good + bad)
    return forest, calibrate(forest.path(steps), good, bad)


def _judge(model: tuple[Forest, float] | None):
    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATS], axis=1)
            n, repeated = stats[:, 0], stats[:, STATS.index("n_repeat_words")]
            failed = (n < MIN_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)
            path = model[0].path(ratios(stats)) if model else np.zeros(len(stats))
            kept = ~failed & (path > model[1] if model else True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(c) for c in BASE), pa.array(failed), pa.array(kept), pa.array(path)],
                ["doc_id", *BASE, "base_failed", "kept", "mean_path"],
            )

    return verdicts


def labelled_steps(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """How many good and bad labelled rows have each combination of steps.

    Repeated rows and repeated labels are counted before they meet, so a hot id joins as few rows.
    """
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad"))
    names = ["s0", "s1", "s2", "s3"]
    rows = measured.where("doc_id IS NOT NULL").select("doc_id", *_steps()).groupBy("doc_id", *names).agg(F.count("*").alias("n"))
    return rows.join(marks, "doc_id").groupBy(*names).agg(*[F.sum(F.col(c) * F.col("n")).alias(c) for c in ("good", "bad")])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, BASE statistics, base_failed, kept and mean path of every row."""
    measured = cut(rule_statistics(docs, id_col, text))
    found = np.array([tuple(r) for r in labelled_steps(measured, labels).collect()], np.int64).reshape(-1, 6)
    found = found[np.lexsort(found.T)]
    model = fit(found[:, :4].astype(np.float64), found[:, 4], found[:, 5])
    return measured.mapInArrow(
        _judge(model),
        "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, mean_path double",
    )
