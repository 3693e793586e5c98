"""Vectorised word and line statistics of many texts at once, on their UTF-8 bytes.

Words are runs of bytes outside space and 0x09-0x0D. Words, windows and lines are compared by 64-bit
hashes: sums of random values per byte times powers of an odd number, which cumulative sums give for
any span without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Texts are handled in chunks of about this many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = [np.uint64(x * 2 + 1) for x in _rng.integers(1, 1 << 62, 4, dtype=np.uint64).tolist()]
_powers: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        factors = np.full(max(n, CHUNK_BYTES + 4096), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors)
    return _powers[base][:n]


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """First index and UTF-8 bytes of consecutive texts; null counts as empty."""
    start, size, held = 0, 0, []
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        if held and size + len(data) > CHUNK_BYTES:
            yield start, held
            start, size, held = i, 0, []
        held.append(data)
        size += len(data) + 1
    if held:
        yield start, held


class Texts:
    """Bytes of some texts, end to end behind one newline each, with their words."""

    def __init__(self, texts: list[bytes]):
        self.bytes = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(sizes + 1) - sizes
        self.ends = self.starts + sizes
        edge = np.flatnonzero(np.diff(SPACE[self.bytes]))
        self.word_start, self.word_end = edge[0::2] + 1, edge[1::2] + 1
        #: Words before each text, and before the end of the last.
        self.first_word = np.append(np.searchsorted(self.word_start, self.starts), len(self.word_start))
        self.n_words = np.diff(self.first_word)
        self.word_text = np.repeat(np.arange(len(texts)), self.n_words)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(self.bytes)
        if not hasattr(self, "_sums"):
            self._sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_VALUE[self.bytes] * _power(_BASE, n), out=self._sums[1:])
        h = (self._sums[end] - self._sums[start]) * _power(_INVERSE, n)[start]
        h ^= h >> np.uint64(29)
        return h * _MIX[0] + (end - start).astype(np.uint64)

    def word_hash(self) -> np.ndarray:
        if not hasattr(self, "_words"):
            self._words = self.span_hash(self.word_start, self.word_end)
        return self._words

    def counts_before(self, which: np.ndarray) -> np.ndarray:
        """For each byte position, how many bytes marked by the table `which` stand before it."""
        out = np.zeros(len(self.bytes) + 1, np.int32)
        np.cumsum(which[self.bytes], out=out[1:])
        return out

    def per_text(self, which: np.ndarray) -> np.ndarray:
        before = self.counts_before(which)
        return (before[self.ends] - before[self.starts]).astype(np.int64)

    def repeated_words(self, width: int = 3) -> np.ndarray:
        """Words of each text in windows of `width` words found twice or more in that text."""
        h, n = self.word_hash(), len(self.word_start)
        if n < width:
            return np.zeros(len(self.starts), np.int64)
        m = n - width + 1
        mixed = self.word_text[:m].astype(np.uint64) * _MIX[3]
        for k in range(width):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[1] + h[k : m + k] * _MIX[2]
        valid = np.flatnonzero(self.word_text[:m] == self.word_text[width - 1 :])
        order = np.argsort(mixed[valid])
        ordered = mixed[valid][order]
        same = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(valid), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        marked = np.zeros(n, bool)
        for k in range(width):
            marked[valid[twice] + k] = True
        return np.bincount(self.word_text[marked], minlength=len(self.starts))

    def repeated_lines(self) -> np.ndarray:
        """Lines of each text that have a word and equal an earlier line of it."""
        breaks = np.flatnonzero(self.bytes == 10)
        start, end = breaks[:-1] + 1, breaks[1:]
        wordy = np.searchsorted(self.word_start, end) > np.searchsorted(self.word_start, start)
        start, end = start[wordy], end[wordy]
        text = np.searchsorted(self.starts, start, side="right") - 1
        h = self.span_hash(start, end)
        mixed = (h ^ (h >> np.uint64(31))) * _MIX[1] + text.astype(np.uint64) * _MIX[3]
        _, first = np.unique(mixed, return_index=True)
        n = len(self.starts)
        return np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of some bytes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power(_BASE, n), out=sums[1:])
    h = (sums[end] - sums[start]) * _power(_INVERSE, n + 1)[start]
    h ^= h >> np.uint64(29)
    h = h * _MIX[0] + (end - start).astype(np.uint64)
    return (h ^ (h >> np.uint64(32))) * _MIX[1]


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the `width` bytes from each position on, by other values than `span_hashes` takes."""
    return grams(_VALUE[data] ^ (_VALUE[data] >> np.uint64(31)), width)


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q characters from each position on."""
    if len(chars) < q:
        return np.zeros(0, np.uint64)
    h, width = chars.astype(np.uint64), 1
    out, done = None, 0
    while True:  # q as a sum of powers of two; windows of twice the width from two of one width
        if q & width:
            part = h if out is None else h * np.uint64(pow(_BASE, done, 1 << 64))
            out = part if out is None else out[: len(part) - done] + part[done:]
            done += width
        if done == q:
            out = out[: len(chars) - q + 1]
            return (out ^ (out >> np.uint64(32))) * np.uint64(_BASE)
        h = h[:-width] + h[width:] * np.uint64(pow(_BASE, width, 1 << 64))
        width *= 2


def table(characters: bytes | range) -> np.ndarray:
    """Lookup table that marks these bytes."""
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


#: Bytes that begin a code point and are not white space.
WORD_CHAR = ~SPACE & ((np.arange(256) & 0xC0) != 0x80)
