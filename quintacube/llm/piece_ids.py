"""SentencePiece BPE by a table of prefixes: encoding without a merge queue, and decoding.

Merging never reaches across the border between two tokens of the result, so every prefix of a text
that ends at such a border is encoded by itself, and the last token of any prefix's encoding is
unique. For each place of a text the table holds the length of that token: of the pieces that an
automaton finds ending there, it is the one whose neighbour, the last token of the prefix before it, stays
apart from it when the two are merged alone. Reading the table from its end gives the tokens. It
takes one entry a character and a bounded number of tests each, however long the text is.

Two tokens stay apart if merging their joint characters in the model's order (highest score first,
leftmost of equals) gives back just the two. That is read from the merges which make each of them,
depends on the pair alone, and is remembered.

Texts are cut where no piece can span (before runs of spaces, before newlines; checked against the
vocabulary), and ids of short parts are kept by the worker, bounded in number and characters. Models
with another normalisation than a space in front, or without byte pieces, are refused.

Null and empty texts have no ids, and no ids decode to the empty text. Null and repeated ids of rows
are kept, one result row per row. An empty table gives no rows. Columns are read by name; others are
ignored by `encode` and kept by `decode`.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quintacube.llm.token_count import SPACE, cuttable, load_model, pieces

#: What a worker keeps: parts of a text in number, in characters of a part and in all; pairs of tokens.
PARTS, PART_CHARS, ALL_CHARS, PAIRS = 1 << 19, 64, 1 << 23, 1 << 20
#: Ids in one batch that a task hands on.
BATCH_IDS = 1 << 18
_NEVER = float("-inf")
_UNKNOWN_SURFACE = " ⁇ "


class Codec:
    """A model's pieces, their automaton, and the ids of parts met so far."""

    def __init__(self, path: str):
        model = load_model(path)
        every = range(model.vocab_size())
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id_of = {model.id_to_piece(i): i for i in plain}
        self._score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self._byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
        if not cuttable(model) or len(self._byte) < 256:
            raise ValueError(f"{path} is not a byte-complete model without normalisation")
        self._matches = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self._matches.add_word(piece, i)
        self._matches.make_automaton()
        self._pieces = [model.id_to_piece(i) for i in every]
        self._size = [len(p) for p in self._pieces]
        self._histories: dict[tuple[int, int], tuple[list[float], list[str]]] = {}
        self._apart: dict[int, bool] = {}
        self._parts: dict[str, bytes] = {}
        self._room = ALL_CHARS
        self._bytes_of = [b""] * len(every)
        for piece, i in self.id_of.items():
            self._bytes_of[i] = piece.replace(SPACE, " ").encode()
        for value, i in self._byte.items():
            self._bytes_of[i] = bytes([value])
        self._is_byte = np.zeros(len(every), bool)
        self._is_byte[list(self._byte.values())] = True
        self._silent = {i for i in every if model.is_control(i)}
        for i in every:
            if model.is_unknown(i):
                self._bytes_of[i] = _UNKNOWN_SURFACE.encode()
        self._spaced = {i for piece, i in self.id_of.items() if piece.startswith(SPACE)}

    def merged(self, chars: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Characters merged in the model's order, and each merge: its score, the first and the last token after it."""
        parts, merges = list(chars), []
        scores = [self._score.get(x + y, _NEVER) for x, y in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > _NEVER:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = self._score.get(parts[at - 1] + parts[at], _NEVER)
            if at < len(scores):
                scores[at] = self._score.get(parts[at] + parts[at + 1], _NEVER)
            merges.append((best, parts[0], parts[-1]))
        return parts, merges

    def _history(self, token: int, side: int) -> tuple[list[float], list[str]]:
        """Scores of the merges that make a token, then none; its outermost part on a side before each and at the end."""
        known = self._histories.get((token, side))
        if known is None:
            chars = self._piece(token)
            merges = self.merged(chars)[1]
            known = [*(m[0] for m in merges), _NEVER], [chars[0 if side == 1 else -1], *(m[side] for m in merges)]
            self._histories[token, side] = known
        return known

    def _piece(self, token: int) -> str:
        return self._pieces[token] if token < len(self._pieces) else chr(token - len(self._pieces))

    def _made(self, token: int) -> bool:
        """Whether merging a token's own characters gives it."""
        return len(self._history(token, 1)[1][-1]) == self._size[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are.

        Until something is merged across their border, each is merged as it is alone. So both histories
        are played together, highest score first; at every state of the border its own pair's score is
        held against the next merge on either side, of which the leftmost goes first if they are equal.
        """
        (to_left, lasts), (to_right, firsts) = self._history(left, 2), self._history(right, 1)
        score, i, j = self._score, 0, 0
        across = score.get(lasts[0] + firsts[0], _NEVER)
        while True:
            one, two = to_left[i], to_right[j]
            if across > one and across >= two:
                return False
            if one >= two:
                if one == _NEVER:
                    return True
                i += 1
            else:
                j += 1
            across = score.get(lasts[i] + firsts[j], _NEVER)

    def last_tokens(self, part: str) -> list[int]:
        """The prefix table: at each place the last token of the part up to there.

        A place that no piece fits to ends a token of one character without a piece; its number lies
        above all pieces.
        """
        table, n, size, known = [-1] * len(part), len(self._pieces), self._size, self._apart
        for end, token in self._matches.iter(part):
            if table[end] >= 0:
                continue
            before = end - size[token]
            if before < 0:
                left, pair = None, token
            else:
                left = table[before]
                if left < 0:
                    left = table[before] = n + ord(part[before])
                pair = left + 1 << 32 | token
            stay = known.get(pair)
            if stay is None:
                stay = self._made(token) and (left is None or self.apart(left, token))
                if len(known) < PAIRS:
                    known[pair] = stay
            if stay:
                table[end] = token
        return [n + ord(part[k]) if t < 0 else t for k, t in enumerate(table)] if -1 in table else table

    def _ids(self, part: str) -> bytes:
        """The tokens, found from the table's end backwards, as 32-bit ids; without a piece, the ids of the bytes."""
        table, n, size, ids = self.last_tokens(part), len(self._pieces), self._size, []
        at = len(part) - 1
        while at >= 0:
            token = table[at]
            if token < n:
                ids.append(token)
                at -= size[token]
            else:
                ids += [self._byte[b] for b in reversed(part[at].encode())]
                at -= 1
        ids.reverse()
        return array("i", ids).tobytes()

    def ids_of_part(self, part: str) -> bytes:
        found = self._parts.get(part)
        if found is None:
            found = self._ids(part)
            if len(part) <= PART_CHARS and len(self._parts) < PARTS and self._room >= len(part):
                self._parts[part] = found
                self._room -= len(part)
        return found

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids_of_part, pieces(text or ""))), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; bytes that are not UTF-8 become U+FFFD one by one."""
        data = b"".join(map(self._bytes_of.__getitem__, ids))
        first = next((i for i in ids if i not in self._silent), None)
        if first in self._spaced:
            data = data[1:]
        if self._silent.isdisjoint(ids):  # silent ids part runs of bytes that they do not show between
            try:
                return data.decode()
            except UnicodeDecodeError:
                pass
        return "".join(self._by_runs(ids, first in self._spaced))

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of consecutive runs of `counts` ids."""
        if not hasattr(self, "_pool"):
            self._pool = np.frombuffer(b"".join(self._bytes_of), np.uint8)
            self._long = np.fromiter(map(len, self._bytes_of), np.int64, len(self._bytes_of))
            self._at = np.cumsum(self._long) - self._long
            self._odd = np.zeros(len(self._long), bool)
            self._odd[list(self._silent)] = True
        n = self._long[ids]
        ends = np.cumsum(n)
        data = self._pool[np.repeat(self._at[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        last = np.cumsum(counts)
        edge, odd = np.append(0, ends)[np.append(0, last)].tolist(), np.append(0, np.cumsum(self._odd[ids]))[np.append(0, last)]
        out = []
        for k, (begin, end) in enumerate(zip((last - counts).tolist(), last.tolist(), strict=True)):
            try:
                if odd[k] != odd[k + 1]:
                    raise ValueError("silent ids part runs of bytes")
                out.append(data[edge[k] + (end > begin and int(ids[begin]) in self._spaced) : edge[k + 1]].decode())
            except ValueError:  # also bytes that are not UTF-8
                out.append(self.decode(ids[begin:end].tolist()))
        return out

    def _by_runs(self, ids: list[int], spaced: bool) -> Iterator[str]:
        """Text of runs of byte pieces and of the other pieces between them."""
        marked = self._is_byte[np.asarray(ids, np.int64)]
        edges = [0, *(np.flatnonzero(np.diff(marked)) + 1).tolist(), len(ids)]
        for a, z in zip(edges, edges[1:], strict=False):
            data = b"".join(map(self._bytes_of.__getitem__, ids[a:z]))
            if marked[a]:
                yield "".join(_characters(data))
            else:
                text = data.decode()
                yield text[1:] if spaced and text else text
                spaced = spaced and not text


#: One well-formed UTF-8 character (fixed values: the ranges of the Unicode standard, table 3-7).
_CHARACTER = re.compile(
    rb"[\x00-\x7F]|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
    rb"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2}"
)


def _characters(data: bytes) -> Iterator[str]:
    at = 0
    while at < len(data):
        found = _CHARACTER.match(data, at)
        yield found[0].decode() if found else "�"
        at = found.end() if found else at + 1


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a model file; a worker makes it once and keeps it over its tasks."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(path)
        for batch in batches:
            held, size, begin = [], 0, 0
            for k, text in enumerate(batch.column(1)):
                held.append(one.encode(text.as_py()))
                size += len(held[-1])
                if size >= BATCH_IDS or k + 1 == len(batch):
                    ends = np.append(0, np.cumsum(list(map(len, held)))).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held)))
                    yield pa.RecordBatch.from_arrays([batch.column(0)[begin : k + 1], ids], ["doc_id", "ids"])
                    held, size, begin = [], 0, k + 1

    return encode


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row; `path` is a .model file that every executor has there."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_encode(path), "doc_id long, ids array<int>")


def _decode(path: str, ids: str, name: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(path)
        for batch in batches:
            column = batch.column(ids)
            counts = np.nan_to_num(pc.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
            flat, total, begin = column.flatten().to_numpy(), np.append(0, np.cumsum(counts)), 0
            while begin < len(batch):
                end = max(begin + 1, int(np.searchsorted(total, total[begin] + BATCH_IDS, side="right")) - 1)
                held = one.decode_all(flat[total[begin] : total[end]], counts[begin:end])
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.string())], [*part.schema.names, name])
                begin = end

    return decode


def decode(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Rows with the text of their ids; null counts as no ids, null among the ids is refused."""
    if name in rows.columns:
        raise ValueError(f"the rows have a column {name} already")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])
    return rows.mapInArrow(_decode(path, ids, name), schema)
