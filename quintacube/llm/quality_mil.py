"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages of `PASSAGE_WORDS` words. Each passage is encoded: its character and
word statistics go through a learned layer. Learned gated attention, softmax(w . (tanh(V h) *
sigmoid(U h))), weighs the passages, and the weighted sum of their encodings is scored by a logistic
output. All weights are learned together from document labels.

At most `FIT_DOCS` labelled documents, in the order of a hash of their id, are learned from, rows that
repeat an id included; every passage of theirs counts, in learning as in scoring. Null
and empty texts are one passage without words. Repeated rows get equal scores. Without labels of
both kinds every score is the share of good labels, or 0.5 without labels. An empty table gives no
rows. Only ids and texts are read; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.llm import words

PASSAGE_WORDS = 64
FIT_DOCS = 4000
HIDDEN, ATTENTION, STEPS, RATE, DECAY, SEED = 16, 8, 200, 0.02, 1e-4, 3

_CLASSES = (
    words.table(b"#*$%&|<>"),
    words.table(b"|"),
    words.table(b"!?"),
    words.table(b".,;:"),
    words.table(range(0x30, 0x3A)),
    words.table(range(0x41, 0x5B)),
    words.table(range(0x61, 0x7B)),
    words.table(range(0xC3, 0xF5)),
    words.table(b"\n"),
)
FEATURES = len(_CLASSES) + 6


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text."""
    features, counts = [], []
    for _, held in words.chunks(texts):
        t = words.Texts(held)
        per_text = np.maximum(1, -(-t.n_words // PASSAGE_WORDS))
        text = np.repeat(np.arange(len(held)), per_text)
        place = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        first = t.first_word[text] + place * PASSAGE_WORDS
        last = np.minimum(first + PASSAGE_WORDS, t.first_word[text + 1])
        n = last - first
        some = n > 0
        out = np.zeros((len(text), FEATURES), np.float32)
        f, e = first[some], last[some]
        start, end = t.word_start[f], t.word_end[e - 1]
        length = np.maximum(end - start, 1)
        for k, which in enumerate(_CLASSES):
            before = t.counts_before(which)
            out[some, k] = (before[end] - before[start]) / length
        sizes = np.concatenate([[0], np.cumsum(t.word_end - t.word_start)])
        squares = np.concatenate([[0], np.cumsum((t.word_end - t.word_start) ** 2)])
        mean = (sizes[e] - sizes[f]) / n[some]
        h = t.word_hash()
        again = np.concatenate([[0, 0], np.cumsum(h[1:] == h[:-1])])
        passage = np.zeros(len(h), np.uint64)
        passage[f[f > 0]] = 1
        passage = np.cumsum(passage)
        distinct = np.unique(h ^ (passage * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
        fresh = np.zeros(len(h) + 1, np.int64)
        fresh[distinct + 1] = 1
        fresh = np.cumsum(fresh)
        k = len(_CLASSES)
        out[some, k] = mean / 10
        out[some, k + 1] = np.sqrt(np.maximum((squares[e] - squares[f]) / n[some] - mean**2, 0)) / 10
        out[some, k + 2] = (again[e] - again[f]) / n[some]
        out[some, k + 3] = (fresh[e] - fresh[f]) / n[some]
        out[some, k + 4] = np.log1p(n[some]) / 5
        out[~some, k + 5] = 1
        features.append(out)
        counts.append(per_text)
    if not counts:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64)
    return np.concatenate(features), np.concatenate(counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Model:
    """Encoder, gated attention and output; `prior` alone answers when nothing could be learned."""

    def __init__(self, prior: float = 0.5):
        self.prior, self.weights = prior, None

    def _forward(self, x: np.ndarray, counts: np.ndarray):
        w = self.weights
        begins = np.cumsum(counts) - counts
        h = np.tanh(x @ w["w"] + w["b"])
        left, gate = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
        e = (left * gate) @ w["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins), counts))
        a = e / np.repeat(np.add.reduceat(e, begins), counts)
        z = np.add.reduceat(a[:, None] * h, begins)
        return h, left, gate, a, z, z @ w["c"] + w["d"][0]

    def learn(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> Model:
        self.prior = float(y.mean()) if len(y) else 0.5
        if not len(y) or y.min() == y.max():
            return self
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.scale
        shapes = {"w": (FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION), "a": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
        self.weights = w = {k: rng.normal(0, 0.3, s) if len(s) > 1 or k in "ac" else np.zeros(s) for k, s in shapes.items()}
        first, second = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
        begins = np.cumsum(counts) - counts
        for step in range(1, STEPS + 1):
            h, left, gate, a, z, logit = self._forward(x, counts)
            dl = (_sigmoid(logit) - y) / len(y)
            dz = np.repeat(dl[:, None] * w["c"], counts, axis=0)
            s = (dz * h).sum(axis=1)
            de = a * (s - np.repeat(np.add.reduceat(a * s, begins), counts))
            d_left = de[:, None] * w["a"] * gate * (1 - left**2)
            d_gate = de[:, None] * w["a"] * left * gate * (1 - gate)
            dh = (a[:, None] * dz + d_left @ w["v"].T + d_gate @ w["u"].T) * (1 - h**2)
            grads = {"w": x.T @ dh, "b": dh.sum(axis=0), "v": h.T @ d_left, "u": h.T @ d_gate, "a": (left * gate).T @ de, "c": z.T @ dl, "d": np.array([dl.sum()])}
            for k, g in grads.items():
                g = g + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(counts), self.prior)
        if not len(counts):
            return np.zeros(0)
        return _sigmoid(self._forward((x - self.mean) / self.scale, counts)[-1])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, counts = passages(batch.column(1).to_pylist())
        bags = []
        for start, n in zip((np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True):
            bags.append(x[start : start + n].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], ["y", "bag"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", fit_docs: int = FIT_DOCS) -> Model:
    """`labels` has doc_id and quality (0 or 1) of the documents to learn from."""
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("_y"))
    chosen = marks.orderBy(F.xxhash64("_id"), "_id", "_y").limit(fit_docs)
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
        .join(F.broadcast(chosen), "_id")
        .select("_y", "_text")
        .mapInArrow(_bags, "y double, bag binary")
        .orderBy(F.xxhash64("y", "bag"), "y", "bag")
        .limit(fit_docs)  # rows that repeat a chosen id do not add to the bound
        .collect()
    )
    rows.sort(key=lambda r: (r["y"], bytes(r["bag"])))  # the same order whichever task is first
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in rows]
    if not bags:
        return Model()
    counts = np.array([len(b) for b in bags])
    return Model().learn(np.concatenate(bags).astype(np.float64), counts, np.array([r["y"] for r in rows]))


def _scores(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(*passages(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    return score


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and score (0 to 1) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scores(model), "doc_id long, score double")


def _accepted(model: Model, text_at: int, limit: float):
    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(*passages(batch.column(text_at).to_pylist()))
            yield batch.filter(pa.array(found >= limit))

    return accept


def accepted(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose score is at least `limit`."""
    return docs.mapInArrow(_accepted(model, docs.columns.index(text), limit), docs.schema)
