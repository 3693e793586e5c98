"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared in lower case with white space runs as one space, by code points. An item of n
characters may differ by e = n // `EDITS_ONE_IN` edits (fewer if it is so short that the lemma would
promise nothing). A copy within that budget shares at least n - q + 1 - q e character q-grams with
the item, on diagonals at most e apart. So shared q-grams are counted in overlapping diagonal bands
2 (e + 1) wide, bands that reach the bound are kept, and banded alignment finds their edit distance.

A q-gram may stand in any number of items, as one of a prompt does that they share. Its places are
counted `POSTINGS` at a time from left to right; counts of bands that lie behind go on to the
alignment and are forgotten. There items are in the order of their texts, so that a common beginning
is aligned once for each place, and pairs beyond their budget stop.

The items are read in blocks of about `BLOCK_CHARS` characters; every block is one pass over all
documents. Equal items are searched once a block. Null and empty texts match nothing, nor do null
items and items of fewer than q characters. Repeated rows and repeated items each have their own
results. Empty tables give no rows. Columns are read by name; others are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut, union_all
from quintacube.llm.words import grams

Q, EDITS_ONE_IN = 8, 12
BLOCK_CHARS = 1 << 23
CHUNK_CHARS = 1 << 19
#: Places of shared q-grams that are counted at once, and cells of alignments that are held at once.
POSTINGS, CELLS = 1 << 20, 1 << 20
_TABLE_BITS = 22


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Index:
    """Positions of the q-grams of some benchmark items; `ids` lists those of each different text."""

    def __init__(self, items: list[tuple[int, str | None]], q: int = Q, one_in: int = EDITS_ONE_IN):
        of_text: dict[str, list[int]] = {}
        for i, t in items:
            if len(t := normal(t)) >= q:
                of_text.setdefault(t, []).append(i)
        texts = sorted(of_text)
        self.q, self.ids = q, [of_text[t] for t in texts]
        self.n = np.fromiter(map(len, texts), np.int64, len(texts))
        self.edits = np.minimum(self.n // one_in, (self.n - q) // q)
        self.bound = self.n - q + 1 - q * self.edits
        if not texts:
            return
        self.chars = codes("".join(texts))
        self.begin = np.cumsum(self.n) - self.n
        n_grams = self.n - q + 1
        item = np.repeat(np.arange(len(texts)), n_grams)
        offset = np.arange(len(item)) - np.repeat(np.cumsum(n_grams) - n_grams, n_grams)
        flat = grams(self.chars, q)[self.begin[item] + offset]
        order = np.argsort(flat, kind="stable")
        self.item, self.offset = item[order], offset[order]
        self.keys, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.keys >> np.uint64(64 - _TABLE_BITS)] = True
        self.reach = int((self.n + self.edits).max())

    def bands(self, chars: np.ndarray, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, band) that reach their item's bound, some at a time; `text` numbers the text of each char."""
        h = grams(chars, self.q)
        at = np.flatnonzero(self.table[h >> np.uint64(64 - _TABLE_BITS)])
        place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        true = self.keys[place] == h[at]
        at, place = at[true], place[true]
        # A hit counts only if it is among enough others for the smallest bound.
        least = int(self.bound.min())
        if len(at) and least > 1:
            ahead = np.searchsorted(at, at + self.reach, side="right")
            dense = np.flatnonzero(ahead - np.arange(len(at)) >= least)
            mark = np.zeros(len(at) + 1, np.int64)
            np.add.at(mark, dense, 1)
            np.add.at(mark, ahead[dense], -1)
            inside = np.cumsum(mark[:-1]) > 0
            at, place = at[inside], place[inside]
        ends = np.cumsum(self.count[place])
        total = int(ends[-1]) if len(at) else 0
        # Numbers of bands are shifted to be positive; every hit is in two overlapping bands.
        shift = self.reach + 2
        width = len(chars) + shift + 1
        key, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for begin in range(0, total, POSTINGS):
            number = np.arange(begin, min(total, begin + POSTINGS))
            hit = np.searchsorted(ends, number, side="right")
            posting = self.first[place[hit]] + number - (ends[hit] - self.count[place[hit]])
            item, where = self.item[posting], at[hit]
            band = (where - self.offset[posting]) // (self.edits[item] + 1) + shift
            new = (text[where] * len(self.ids) + item) * width + band
            new, n_new = np.unique(np.concatenate([new, new - 1]), return_counts=True)
            key, back = np.unique(np.concatenate([key, new]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n_new]), len(key)).astype(np.int64)
            group, band = key // width, key % width - shift
            item = group % len(self.ids)
            # The last hit that a band can hold; hits to come are at the last one's place or behind it.
            last = (band + 2) * (self.edits[item] + 1) - 1 + self.n[item] - self.q
            over = (last < where[-1]) | (begin + POSTINGS >= total)
            found = over & (counts >= self.bound[item])
            if found.any():
                yield group[found] // len(self.ids), item[found], band[found]
            key, counts = key[~over], counts[~over]

    def align(self, chars: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray, band: np.ndarray):
        """Least edits of each item against a part of its text within its band, and where it ends.

        Diagonals up to e outside the band are included: edits beyond the outermost q-grams. Pairs that
        exceed their item's budget get a number beyond it.
        """
        best, stop = np.full(len(item), np.iinfo(np.int32).max, np.int64), np.zeros(len(item), np.int64)
        edits = self.edits[item]
        low = band * (edits + 1) - edits
        # Items are numbered in the order of their texts.
        order, done = np.lexsort((item, low, start, edits)), 0
        while done < len(order):
            most = order[done : done + max(1, CELLS // self.q)]
            size = max(1, int(np.searchsorted(np.maximum.accumulate(self.n[item[most]]) * np.arange(1, len(most) + 1), CELLS)))
            part, done = most[:size], done + size
            best[part], stop[part] = self._align(chars, start[part], end[part], item[part], edits[part], low[part])
        return best, stop

    def _align(self, chars, start, end, item, e, low):
        """`align` for pairs in order. Pairs that agree so far in place and item share a row of the
        table, that of the first of them."""
        size, n = len(item), self.n[item]
        best, stop = np.full(size, np.iinfo(np.int32).max, np.int64), np.zeros(size, np.int64)
        rows = self.chars[np.minimum(self.begin[item][:, None] + np.arange(n.max()), len(self.chars) - 1)]
        # Characters that a pair shares with the one before; -1: another place or budget.
        share = np.full(size, -1, np.int64)
        differ = rows[1:] != rows[:-1]
        same = (start[1:] == start[:-1]) & (low[1:] == low[:-1]) & (e[1:] == e[:-1])
        share[1:] = np.where(same, np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1]), -1)
        left = np.ones(size, bool)
        lead = np.flatnonzero(share < 0)
        k, far = np.arange(int((4 * e + 2).max())), np.int64(1 << 20) + self.reach
        text_at = low[lead, None] + k  # position in the text that diagonal k has at item row 0
        outside = (text_at < start[lead, None]) | (text_at > end[lead, None]) | (k >= (4 * e[lead] + 2)[:, None])
        d = np.where(outside, far, 0)  # the match may begin anywhere
        for i in range(1, rows.shape[1] + 1):
            fresh = np.flatnonzero((share == i - 1) & left)
            if len(fresh):  # these differ from their leader in this character
                lead, old = np.union1d(lead, fresh), lead
                d = d[np.searchsorted(old, lead, side="right") - 1]
            j = low[lead, None] + k + i  # text position after this row on each diagonal
            inside = (j >= start[lead, None]) & (j <= end[lead, None]) & (k < (4 * e[lead] + 2)[:, None])
            equal = chars[np.clip(j - 1, 0, len(chars) - 1)] == rows[lead, i - 1, None]
            new = np.where(inside & (j > start[lead, None]), d + ~equal, far)
            new[:, :-1] = np.minimum(new[:, :-1], d[:, 1:] + 1)  # a character of the item left out
            new = np.where(inside, new, far)
            d = np.minimum(new, np.minimum.accumulate(new - k, axis=1) + k)  # characters put in
            ended = np.flatnonzero((n == i) & left)
            if len(ended):
                of = np.searchsorted(lead, ended, side="right") - 1
                at = d[of].argmin(axis=1)
                best[ended], stop[ended] = d[of, at], low[ended] + at + i
            if i % 8 == 0 or len(ended):
                pairs = np.flatnonzero(left)
                of = np.searchsorted(lead, pairs, side="right") - 1
                wanted = np.zeros(len(lead), bool)
                wanted[of[n[pairs] > i]] = True
                wanted &= d.min(axis=1) <= e[lead]
                left[pairs[~wanted[of]]] = False
                lead, d = lead[wanted], d[wanted]
                if not len(lead):
                    break
        return best, stop

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, edits, start, end) of the best match of each item found in each text.

        Positions are those of the normalised text; start is the end less the item's length.
        """
        if not self.ids:
            return
        held, size, first = [], 0, 0
        for number, text in enumerate([*texts, None]):
            if held and (number == len(texts) or size > CHUNK_CHARS):
                yield from self._chunk(held, first)
                held, size, first = [], 0, number
            held.append(normal(text))
            size += len(held[-1]) + 1

    def _chunk(self, held: list[str], first: int) -> Iterator[tuple[int, int, int, int, int]]:
        chars = codes("\0".join(held))
        sizes = np.fromiter(map(len, held), np.int64, len(held))
        start = np.cumsum(sizes + 1) - (sizes + 1)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for text, item, band in self.bands(chars, np.repeat(np.arange(len(held)), sizes + 1)):
            edits, stop = self.align(chars, start[text], start[text] + sizes[text], item, band)
            good = edits <= self.edits[item]
            pairs = zip(*(x[good].tolist() for x in (text, item, edits, stop)), strict=True)
            for t, i, d, s in pairs:
                if (t, i) not in found or (d, s) < found[t, i]:
                    found[t, i] = (d, s)
        for (t, i), (d, s) in sorted(found.items()):
            stop_at = s - int(start[t])
            yield first + t, i, d, max(0, stop_at - int(self.n[i])), stop_at


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str | None]]]:
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    # Repeated items are counted before they come to the driver.
    items = cut(items.groupBy("id", "t").agg(F.count("*").alias("n")))
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_CHARS))
    number = F.pmod(F.xxhash64("id", "t"), F.lit(blocks))
    for block in range(blocks):
        rows = items.where(number == block).collect()
        yield sorted((pair for r in rows for pair in [(r["id"], r["t"])] * r["n"]), key=str)


MATCHES = "doc_id long, item_id long, edits int, start long, end long"


def _search(index: Index):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [
                (ids[t], item, d, s, e)
                for t, i, d, s, e in index.matches(batch.column(1).to_pylist())
                for item in index.ids[i]
            ]
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "item_id", "edits", "start", "end"],
            )

    return search


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row for each document and benchmark item that it contains within the edit budget."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return union_all(
        [rows.mapInArrow(_search(Index(block)), MATCHES) for block in _blocks(benchmark, item_id, item_text)]
    )


def _clean(index: Index, text_at: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[m[0] for m in index.matches(batch.column(text_at).to_pylist())]] = False
            yield batch.filter(pa.array(keep))

    return clean


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The documents, all columns, that contain no benchmark item."""
    for number, block in enumerate(_blocks(benchmark, item_id, item_text)):
        if number:
            docs = cut(docs)
        docs = docs.mapInArrow(_clean(Index(block), docs.columns.index(text)), docs.schema)
    return docs
