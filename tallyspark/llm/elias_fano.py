"""Elias-Fano sequences and n-gram trie levels over flat numpy arrays, queried in vectorised steps."""

from __future__ import annotations

import json

import numpy as np


class EliasFano:
    """A non-decreasing sequence of integers: low bits packed, high bits in unary, about 2 + log2(u/n) bits each.

    ``arrays()`` are flat buffers, so a model can be broadcast or mapped and used without copies.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = 64 * np.arange(len(high) + 1) - self.ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        width = max(0, int(top // max(1, n)).bit_length() - 1)
        bits = np.zeros((n * width + 63) // 64 * 64 + 128, bool)
        for k in range(width):
            bits[k : n * width : width] = (values >> k) & 1
        low = np.packbits(bits, bitorder="little").view("<u8")
        del bits
        place = (values >> width) + np.arange(n)
        unary = np.zeros((int(place[-1]) + 2 if n else 1) + 63, bool)
        unary[place] = True
        high = np.packbits(unary[: len(unary) // 64 * 64], bitorder="little").view("<u8")
        return cls(n, width, low, high)

    def arrays(self) -> tuple:
        return self.n, self.width, self.low, self.high

    @staticmethod
    def _in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th set bit (from 0) of each word."""
        place, k, word = np.zeros(len(word), np.int64), k.copy(), word.copy()
        for half in (32, 16, 8, 4, 2, 1):
            lower = word & np.uint64((1 << half) - 1)
            n = np.bitwise_count(lower).astype(np.int64)
            up = k >= n
            k -= np.where(up, n, 0)
            place += np.where(up, half, 0)
            word = np.where(up, word >> np.uint64(half), lower)
        return place

    def _select(self, rank: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
        at = np.searchsorted(rank, k, "right") - 1
        at = np.minimum(at, len(self.high) - 1)
        word = ~self.high[at] if flip else self.high[at]
        return 64 * at + self._in_word(word, k - rank[at])

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # a value may lie across two words; a shift by 64 is done in two steps
        both = (self.low[word] >> shift) | ((self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        return (both & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        return ((self._select(self.ones, i, False) - i) << self.width) | self.low_bits(i)

    def successor(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first position in [begin, end) whose value is ``x`` or more (``end`` if none)."""
        high, low = x >> self.width, x & ((1 << self.width) - 1)
        last = int(self.zeros[-1])

        def before(h: np.ndarray) -> np.ndarray:
            # values with high bits below h: ones before the h-th zero
            out = np.full(len(h), self.n, np.int64)
            out[h <= 0] = 0
            live = (h > 0) & (h <= last)
            k = h[live] - 1
            out[live] = np.minimum(self._select(self.zeros, k, True) - k, self.n)
            return out

        at = np.clip(before(high), begin, end)
        stop = np.clip(before(high + 1), begin, end)
        # values with the same high bits are sorted by their low bits: halve each range until it is empty
        open_ = np.flatnonzero(at < stop)
        a, b, low = at[open_], stop[open_], low[open_]
        while len(open_):
            mid = (a + b) >> 1
            less = self.low_bits(mid) < low
            a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            at[open_] = a
            more = a < b
            open_, a, b, low = open_[more], a[more], b[more], low[more]
        return at


class Level:
    """One trie level: for each context a sorted range of word ids, made monotone by adding the last value of the
    range before it, with pointers to the ranges and an 8-bit code for each number kept with an entry."""

    def __init__(self, pointers: EliasFano, words: EliasFano, codes: dict[str, np.ndarray], books: dict[str, np.ndarray]):
        self.pointers, self.words, self.codes, self.books = pointers, words, codes, books

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, contexts: int, codes: dict[str, np.ndarray], books: dict[str, np.ndarray]) -> Level:
        """``context``/``word`` sorted; ``codes`` are places in ``books``, one for each entry and number."""
        count = np.bincount(context, minlength=contexts) if len(context) else np.zeros(contexts, np.int64)
        edge = np.concatenate([[0], np.cumsum(count)])
        last = np.zeros(contexts + 1, np.int64)
        full = np.flatnonzero(count)
        last[full + 1] = word[edge[full + 1] - 1]
        base = np.cumsum(last)[:-1]
        values = word + base[context] if len(word) else word
        return cls(EliasFano.of(edge), EliasFano.of(values), codes, books)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The entry of each (context, word), or -1; equal queries are searched once."""
        out = np.full(len(word), -1, np.int64)
        live = np.flatnonzero((context >= 0) & (word >= 0))
        if not len(live) or not self.words.n:
            return out
        span = int(word.max()) + 1
        keys, place = np.unique(context[live] * span + word[live], return_inverse=True)
        out[live] = self._find(keys // span, keys % span)[place]
        return out

    def _find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        out, live = np.full(len(word), -1, np.int64), np.arange(len(word))
        begin, end = self.pointers.get(context[live]), self.pointers.get(context[live] + 1)
        some = end > begin
        live, begin, end = live[some], begin[some], end[some]
        base = np.zeros(len(live), np.int64)
        later = begin > 0
        base[later] = self.words.get(begin[later] - 1)
        x = base + word[live]
        at = self.words.successor(x, begin, end)
        hit = at < end
        hit[hit] = self.words.get(at[hit]) == x[hit]
        out[live[hit]] = at[hit]
        return out

    def number(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.books[name][self.codes[name][at]]

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        """Flat arrays by name, for ``saved``."""
        out = {}
        for part, e in (("pointers", self.pointers), ("words", self.words)):
            n, width, low, high = e.arrays()
            out |= {f"{name}.{part}.size": np.array([n, width]), f"{name}.{part}.low": low, f"{name}.{part}.high": high}
        return out | {f"{name}.code.{k}": v for k, v in self.codes.items()}

    @classmethod
    def load(cls, arrays: dict[str, np.ndarray], name: str, books: dict[str, np.ndarray]) -> Level:
        def sequence(part: str) -> EliasFano:
            n, width = arrays[f"{name}.{part}.size"].tolist()
            return EliasFano(n, width, arrays[f"{name}.{part}.low"], arrays[f"{name}.{part}.high"])

        mark = f"{name}.code."
        return cls(sequence("pointers"), sequence("words"), {k.removeprefix(mark): v for k, v in arrays.items() if k.startswith(mark)}, books)


def saved(arrays: dict[str, np.ndarray]) -> list[bytes]:
    """A file of arrays: a head that names them, then each one aligned to 64 bytes, so that it can be mapped."""
    place, head, body = 0, {}, []
    for name, x in arrays.items():
        raw = np.ascontiguousarray(x).tobytes()
        pad = -len(raw) % 64
        head[name] = (x.dtype.str, place, len(x))
        body += [raw, b"\0" * pad]
        place += len(raw) + pad
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    return [len(text).to_bytes(8, "little"), text, *body]


def mapped(data) -> dict[str, np.ndarray]:
    """The arrays of a file, as views of its mapped bytes."""
    raw = np.frombuffer(data, np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8:8 + size].tobytes())
    return {name: np.frombuffer(data, kind, n, 8 + size + place) for name, (kind, place, n) in head.items()}
