"""External induced sorting of suffixes, with common-prefix values.

Suffixes are L-type (greater than the next suffix) or S-type. Only the leftmost S-type suffixes of
each run are sorted, by recursion on a string of their substrings' names; the rest follow by
induction: taking sorted suffixes in order, the suffix one position before each goes to a priority
queue keyed by its first symbol and the rank of its successor. Ranks only grow, so inside a symbol
the queue is first in, first out; it holds arrays of (position, common prefix) tuples and moves them
to an unlinked scratch file beyond a memory budget. One pass up the alphabet gives the L-type
suffixes, one pass down gives the S-type ones and the final order. The common prefix of neighbours
is one more than the least value passed between their successors, which is carried along per symbol.

Common prefixes count up to `need` symbols, and so does the order: suffixes that agree on `need`
symbols stand together in any order. The recursion ends in memory once at most `memory` names are
left. Texts, types and seeds beyond the budget are memory-mapped scratch arrays.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY_SYMBOLS = 1 << 21
QUEUE_TUPLES = 1 << 20
_FAR = np.int32(1 << 30)


def scratch(n: int, kind: type, memory: int) -> np.ndarray:
    """An array of n zeros; in an unlinked file of the task's temporary folder if it is large."""
    if n <= 8 * memory:
        return np.zeros(n, kind)
    with tempfile.TemporaryFile() as file:
        file.truncate(n * np.dtype(kind).itemsize)
        return np.memmap(file, kind, "r+", shape=(n,))


class TupleQueue:
    """Monotone priority queue of (position, common prefix) tuples, keyed by symbol, then arrival."""

    def __init__(self, length: int, memory: int = QUEUE_TUPLES):
        self._kind = np.dtype(np.int32 if length < 1 << 31 else np.int64)
        self._held: dict[int, list[np.ndarray]] = {}
        self._spilled: dict[int, list[tuple[int, int]]] = {}
        self._memory, self._size, self._file = memory, 0, None

    def push(self, symbol: int, position: np.ndarray, prefix: np.ndarray) -> None:
        self._held.setdefault(symbol, []).append(np.stack([position, prefix]).astype(self._kind))
        self._size += len(position)
        if self._size > self._memory:
            self._spill()

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        end = self._file.seek(0, 2)
        for symbol, parts in self._held.items():
            data = np.concatenate(parts, axis=1)
            self._file.write(np.ascontiguousarray(data).tobytes())
            self._spilled.setdefault(symbol, []).append((end, data.shape[1]))
            end += data.nbytes
        self._held, self._size = {}, 0

    def __contains__(self, symbol: int) -> bool:
        return symbol in self._held or symbol in self._spilled

    def symbols(self) -> set[int]:
        return self._held.keys() | self._spilled.keys()

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of the symbol so far, in order of arrival."""
        parts = []
        for start, n in self._spilled.pop(symbol, ()):
            self._file.seek(start)
            parts.append(np.frombuffer(self._file.read(2 * n * self._kind.itemsize), self._kind).reshape(2, n))
        held = self._held.pop(symbol, [])
        self._size -= sum(p.shape[1] for p in held)
        both = np.concatenate(parts + held, axis=1)
        return both[0].astype(np.int64), both[1].astype(np.int64)


class _Pass:
    """One induction: up the alphabet for L-type suffixes, down for S-type ones."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, sigma: int, need: int, queue: TupleQueue):
        self.text, self.wanted, self.need, self.queue = text, wanted, need, queue
        self.least = np.zeros(sigma, np.int64)  # least prefix passed since the symbol's last push

    def take(self, position: np.ndarray, prefix: np.ndarray) -> None:
        """Tuples in rank order; `prefix` is in common with the tuple before."""
        before = position - 1
        ok = np.flatnonzero((before >= 0) & self.wanted[np.maximum(before, 0)])
        whole = prefix.min()
        if not len(ok):
            np.minimum(self.least, whole, out=self.least)
            return
        symbol = self.text[before[ok]]
        order = np.argsort(symbol, kind="stable")
        at, symbol = ok[order], symbol[order]
        firsts = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
        lasts = np.append(firsts[1:], len(at)) - 1
        now = symbol[firsts]
        common = np.empty(len(at), np.int64)
        tail = np.empty(len(now), np.int64)
        for k, (a, z) in enumerate(zip(firsts.tolist(), lasts.tolist(), strict=True)):
            ends = at[a : z + 1]
            bounds = np.append(0, ends + 1)
            if bounds[-1] == len(prefix):
                common[a : z + 1] = np.minimum.reduceat(prefix, bounds[:-1])
                tail[k] = _FAR
            else:
                found = np.minimum.reduceat(prefix, bounds)
                common[a : z + 1], tail[k] = found[:-1], found[-1]
        common[firsts] = np.minimum(common[firsts], self.least[now])
        np.minimum(common + 1, self.need, out=common)
        np.minimum(self.least, whole, out=self.least)
        self.least[now] = tail
        first_of_symbol = [s not in self._begun for s in now.tolist()]
        common[firsts[first_of_symbol]] = 0
        self._begun.update(now.tolist())
        for s, a, z in zip(now.tolist(), firsts.tolist(), lasts.tolist(), strict=True):
            self.queue.push(s, before[at[a : z + 1]], common[a : z + 1])

    def run(self, up: bool, seeds: TupleQueue, first: np.ndarray) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
        """Yield (symbol, induced, positions, prefixes) in order; seeds follow the induced tuples."""
        self._begun: set[int] = set()
        if len(first):
            self.take(first, np.zeros(len(first), np.int64))
        for symbol in range(len(self.least)) if up else range(len(self.least) - 1, -1, -1):
            last = None
            while symbol in self.queue:
                position, prefix = self.queue.pop(symbol)
                yield symbol, True, position, prefix
                self.take(position, prefix)
                last = position[-1]
            if symbol in seeds:
                position, prefix = seeds.pop(symbol)
                prefix = prefix.copy()
                prefix[0] = 0 if last is None else min(self._run(last), self._run(position[0]), self.need)
                yield symbol, False, position, prefix
                self.take(position, prefix)

    def _run(self, position: int) -> int:
        part = self.text[position : position + self.need]
        other = np.flatnonzero(part != part[0])
        return int(other[0]) if len(other) else len(part)


def _types(text: np.ndarray, memory: int) -> np.ndarray:
    """Whether each suffix is S-type; the end counts as the smallest symbol."""
    n = len(text)
    change = scratch(n, np.int8, memory)
    change[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    change[-1] = -1
    steps = np.flatnonzero(change)
    return np.repeat(change[steps] > 0, np.diff(steps, prepend=-1))


def _names(text: np.ndarray, start: np.ndarray, sigma: int) -> np.ndarray:
    """Order of the substrings from each start to the next; where one ends, it is the greater."""
    n = len(text)
    end = np.append(start[1:], n)
    bits = int(sigma).bit_length() + 1
    per, pad = max(1, 62 // bits), (1 << bits) - 1
    name = np.zeros(len(start), np.int64)
    open_, offset = np.arange(len(start)), 0
    while len(open_):
        key = np.zeros(len(open_), np.int64)
        for k in range(offset, offset + per):
            at = start[open_] + k
            inside = at <= end[open_]
            symbol = np.where(at < n, text[np.minimum(at, n - 1)].astype(np.int64) + 1, 0)
            key = (key << bits) | np.where(inside, symbol, pad)
        order = np.lexsort((key, name[open_]))
        group, key = name[open_][order], key[order]
        fresh = np.append(True, (group[1:] != group[:-1]) | (key[1:] != key[:-1]))
        # Names leave room: a group's members are numbered from the group's own number on.
        where = np.arange(len(order))
        begin = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), where, 0))
        name[open_[order]] = group + np.maximum.accumulate(np.where(fresh, where, 0)) - begin
        offset += per
        counts = np.diff(np.append(np.flatnonzero(fresh), len(order)))
        tied = np.repeat(counts > 1, counts)
        left = open_[order[tied]]
        # One that has just ended is held against the others once more: there it is the greater.
        open_ = left[start[left] + offset <= end[left] + 1]
    return np.unique(name, return_inverse=True)[1]


def _in_memory(text: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes of all suffixes by prefix doubling up to `need` symbols."""
    n, rank, ranks, width = len(text), text.astype(np.int64), [], 1
    order = np.argsort(rank, kind="stable")
    at, key = np.arange(n), rank[order]
    while True:  # a rank is the place of the first of its equals; only those that have equals are sorted on
        fresh = np.append(True, key[1:] != key[:-1])
        begin = np.flatnonzero(fresh)
        counts = np.diff(np.append(begin, len(at)))
        rank = rank.copy()
        rank[order[at]] = np.repeat(at[begin], counts)
        ranks.append(rank)
        at = at[np.repeat(counts > 1, counts)]
        if width >= need or not len(at):
            break
        member = order[at]
        following = np.where(member + width < n, rank[np.minimum(member + width, n - 1)] + 1, 0)
        key = rank[member] * (n + 1) + following
        inside = np.argsort(key)
        order[at], key = member[inside], key[inside]
        width *= 2
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(n, np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        ok = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[ok] = ranks[k][a[ok]] == ranks[k][b[ok]]
        # A rank of 2^k symbols compares suffixes that end earlier too; equal ones are all there.
        a[same] += 1 << k
        b[same] += 1 << k
        common[1:][same] += 1 << k
    return order, np.minimum(common, need)


def _extend(text: np.ndarray, a: np.ndarray, b: np.ndarray, common: np.ndarray, need: int) -> np.ndarray:
    """Common prefixes from known lower bounds on."""
    n, common = len(text), np.minimum(common, need)
    active = np.flatnonzero(common < need)
    while len(active):
        x, y = a[active] + common[active], b[active] + common[active]
        ok = (x < n) & (y < n)
        same = ok & (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)])
        active = active[same]
        common[active] += 1
        active = active[common[active] < need]
    return common


def suffixes(
    text: np.ndarray, sigma: int, need: int, memory: int = MEMORY_SYMBOLS, queue: int = QUEUE_TUPLES
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in descending order: batches of (positions, prefixes in common with the one before).

    Symbols are below `sigma`.
    """
    n = len(text)
    if not n:
        return
    small = _types(text, memory)
    star = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    seeds = TupleQueue(n, queue)
    if len(star):
        names = _names(text, star, sigma)
        enough = -(-need // 2)  # every name stands for two symbols at least
        if len(star) <= memory:
            order, common = _in_memory(names, enough)
        else:
            order, common = scratch(len(star), np.int64, memory), scratch(len(star), np.int64, memory)
            place = len(star)
            for position, prefix in suffixes(names, int(names.max()) + 1, enough, memory, queue):
                place -= len(position)
                order[place : place + len(position)] = position[::-1]
                common[place + 1 : place + 1 + len(position)] = prefix[::-1][: len(star) - place - 1]
            common[0] = 0
        known = np.append(star, n)[order[1:] + common[1:]] - star[order[1:]]
        sorted_ = star[order]
        prefix = np.append(0, _extend(text, sorted_[:-1], sorted_[1:], known, need))
        symbol = text[sorted_]
        bounds = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])).tolist() + [len(sorted_)]
        for a, z in zip(bounds[:-1], bounds[1:], strict=True):
            seeds.push(int(symbol[a]), sorted_[a:z], prefix[a:z])
    large = TupleQueue(n, queue)
    for symbol, induced, position, prefix in _Pass(text, ~small, sigma, need, TupleQueue(n, queue)).run(True, seeds, np.array([n])):
        if induced:
            large.push(symbol, position, prefix)
    back = TupleQueue(n, queue)
    for symbol in large.symbols():
        position, prefix = large.pop(symbol)
        back.push(symbol, position[::-1], np.append(0, prefix[:0:-1]))
    for _, _, position, prefix in _Pass(text, small, sigma, need, TupleQueue(n, queue)).run(False, back, np.zeros(0, np.int64)):
        yield position, prefix
