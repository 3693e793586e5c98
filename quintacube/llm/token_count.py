"""Token counts by a map-side two-tier lookup, without any shuffle of pre-tokens.

First tier: the lengths in tokens of the most frequent pre-tokens of the whole corpus, found by one
mergeable top-k sketch and broadcast as a small table of at most `FREQUENT` entries. Second tier:
each worker encodes what the table misses and keeps the lengths over its tasks, bounded in number and
characters. Long pre-tokens enter neither tier. The sketch's errors cost time only; every length comes
from the tokenizer.

A sentencepiece model is looked up piecewise only if that is exact: identity normalisation, and no
vocabulary entry that spans a place where texts are cut (before a run of spaces, before a newline).
Other models and the other libraries' tokenizers encode whole texts.

Null and empty texts have no bytes and no tokens. Special strings in a text are ordinary text or not
as the library's default has it; no begin or end tokens are added. Repeated rows each have a result
row. An empty table gives no rows. Columns are read by name; others are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut

FREQUENT, TRACKED = 8192, 16384
#: Sketches that are left for the last merge.
SKETCHES = 64
#: What a worker keeps: pre-tokens in number, in characters of one and in all.
CACHED, PIECE_CHARS, ALL_CHARS = 1 << 19, 64, 1 << 23
LIMIT = 4096

#: How sentencepiece shows a space inside pieces.
SPACE = "▁"
_PIECE = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*")


def cuttable(model) -> bool:
    """Whether pieces never span a cut and texts are only given a space in front."""
    probe = "a  béﬁ\tc "
    shown = "".join(model.id_to_piece(i) for i in range(model.vocab_size()) if not model.is_byte(i) and not model.is_control(i))
    spans = any(
        "\n" in piece or re.search(f"[^{SPACE}]{SPACE}", piece)
        for piece in map(model.id_to_piece, range(model.vocab_size()))
    )
    return not spans and bool(shown) and model.normalize(probe) == (" " + probe).replace(" ", SPACE)


def pieces(text: str) -> list[str]:
    """The text as the model sees it, cut before runs of spaces and before newlines."""
    return _PIECE.findall(SPACE + text.replace(" ", SPACE)) if text else []


class Lengths(dict):
    """Token counts of pre-tokens; a missing one is encoded, and kept while there is room."""

    def __init__(self, model):
        super().__init__()
        self._encode, self._room = model.encode, ALL_CHARS
        self.frequent: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        n = self.frequent.get(piece)
        if n is not None:
            return n
        # The newline keeps the piece apart from the space put in front: two tokens, never merged.
        n = len(self._encode("\n" + piece)) - 2
        if len(piece) <= min(PIECE_CHARS, self._room) and len(self) < CACHED:
            self[piece] = n
            self._room -= len(piece)
        return n


_lengths: dict[str, Lengths] = {}


def lengths(path: str, frequent: dict[str, int]) -> Lengths:
    """The counts of a model file; a worker loads it once and keeps them over its tasks."""
    if path not in _lengths:
        _lengths[path] = Lengths(load_model(path))
    _lengths[path].frequent = frequent
    return _lengths[path]


def whole_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of whole texts by the library that the file belongs to."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    model = load_model(path)
    return lambda texts: [len(model.encode(t)) for t in texts]


def load_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def frequent_pieces(docs: DataFrame, text: str, k: int = FREQUENT, tracked: int = TRACKED) -> list[str]:
    """The most frequent pre-tokens that stand behind one space, by a sketch over all texts."""
    words = docs.select(F.explode(F.split(text, "[ \n]")).alias("w")).where(F.length("w") < PIECE_CHARS)
    # Merged in two steps, so that the last task gets a fixed number of sketches.
    some = cut(
        words.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("part")).agg(
            F.expr(f"approx_top_k_accumulate(w, {tracked})").alias("sketch")
        )
    )
    if some.isEmpty():
        return []
    # Grouped by one value: without a group, a task that gets no sketch would hand on an empty one, which has no type and fails.
    merged = some.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    found = merged.select(
        F.expr(f"approx_top_k_estimate(sketch, {k})").alias("top")
    )
    top = found.first()["top"] or []
    return [SPACE + r["item"] for r in top if r["item"] is not None and SPACE not in r["item"]]


def _counts(path: str, table: dict[str, int] | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if table is None:
            of_all = whole_counter(path)
        else:
            look_up = lengths(path, table).__getitem__
            of_all = lambda texts: [sum(map(look_up, pieces(t))) for t in texts]
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(of_all(texts), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return count


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Id, n_bytes, n_tokens and over_limit of every row; `path` is a .model or .json file that every
    executor has at that place."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    table = None
    if path.endswith(".model") and cuttable(model := load_model(path)):
        encode = Lengths(model)
        table = {piece: encode[piece] for piece in frequent_pieces(docs, text)}
    counted = rows.mapInArrow(_counts(path, table), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
