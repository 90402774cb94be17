"""Elias-Fano sequences and an n-gram trie over them, as numpy arrays that can live in one memory-mapped file."""

from __future__ import annotations

import json
import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_U = np.uint64


def _select_in_word(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the ``k``-th set bit (from 0) of each word."""
    x, k, pos = x.copy(), k.astype(np.int64), np.zeros(len(x), np.int64)
    for s in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(x & _U((1 << s) - 1)).astype(np.int64)
        go = k >= low
        k = np.where(go, k - low, k)
        x = np.where(go, x >> _U(s), x)
        pos += go * s
    return pos


class EliasFano:
    """A non-decreasing sequence of ``n`` integers below ``universe`` in about ``2 + log2(universe / n)`` bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones_before = np.concatenate([[0], np.cumsum(ones)])[:-1]
        self.zeros_before = 64 * np.arange(len(high), dtype=np.int64) - self.ones_before

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        bits = max(0, (universe // max(1, n)).bit_length() - 1)
        tops = (values >> _U(bits)).astype(np.int64) if bits < 64 else np.zeros(n, np.int64)
        length = n + (universe >> bits) + 2
        high = np.zeros(-(-length // 64) + 1, np.uint64)
        at = tops + np.arange(n)
        np.bitwise_or.at(high, at >> 6, _U(1) << (at & 63).astype(np.uint64))
        low = np.zeros(-(-n * bits // 64) + 2, np.uint64)
        if bits:
            v = values & _U((1 << bits) - 1)
            p = np.arange(n, dtype=np.int64) * bits
            off = (p & 63).astype(np.uint64)
            np.bitwise_or.at(low, p >> 6, v << off)
            over = (p & 63) + bits > 64
            np.bitwise_or.at(low, (p[over] >> 6) + 1, v[over] >> (_U(64) - off[over]))
        return cls(n, bits, low, high)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        p = i * self.low_bits
        off = (p & 63).astype(np.uint64)
        first = self.low[p >> 6] >> off
        # a shift by 64 is not defined: shift by 63 - off, then by one more
        second = (self.low[(p >> 6) + 1] << (_U(63) - off)) << _U(1)
        return (first | second) & _U((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The ``i``-th values."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones_before, i, side="right") - 1
        at = 64 * word + _select_in_word(self.high[word], i - self.ones_before[word])
        return ((at - i).astype(np.uint64) << _U(self.low_bits)) | self._low(i)

    def _ones_before_zero(self, k: np.ndarray) -> np.ndarray:
        """How many ones precede the ``k``-th zero."""
        word = np.searchsorted(self.zeros_before, k, side="right") - 1
        at = 64 * word + _select_in_word(~self.high[word], k - self.zeros_before[word])
        return at - k

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value that is not below ``x``; ``n`` if there is none. ``x`` is below the universe."""
        x = np.asarray(x, np.uint64)
        top = (x >> _U(self.low_bits)).astype(np.int64)
        lo = np.where(top > 0, self._ones_before_zero(np.maximum(top - 1, 0)), 0)
        hi = self._ones_before_zero(top)
        want = x & _U((1 << self.low_bits) - 1)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)


class Trie:
    """Two levels. Level one: the context words' hashes, increasing, with monotone pointers to their successors.
    Level two: for each context its successors' numbers in the trie's vocabulary, increasing, made one monotone
    sequence by adding what the contexts before end with; beside it the quantised probabilities."""

    def __init__(self, vocabulary: EliasFano, contexts: EliasFano, pointers: EliasFano, values: EliasFano, codes):
        self.vocabulary, self.contexts, self.pointers, self.values = vocabulary, contexts, pointers, values
        self.codes = codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, codes: np.ndarray, word_bits: int) -> Trie:
        """From distinct n-grams sorted by context and word, with the code of each."""
        vocab = np.unique(word)
        number = np.searchsorted(vocab, word).astype(np.int64)
        n = len(context)
        new = np.ones(n, bool)
        new[1:] = context[1:] != context[:-1]
        begin = np.flatnonzero(new)
        end = np.r_[begin[1:], n] if n else begin
        span = number[end - 1] + 1 if n else np.empty(0, np.int64)  # room each context needs
        base = np.cumsum(span) - span
        values = number + np.repeat(base, end - begin)
        room = int(span.sum()) + 1
        return cls(
            EliasFano.build(vocab, 1 << word_bits),
            EliasFano.build(context[begin], 1 << 64),
            EliasFano.build(np.r_[begin, n], n + 1),
            EliasFano.build(values, room + len(vocab)),
            codes.astype(np.uint16),
        )

    def codes_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each n-gram, 0 where the trie has none: the context is found, then the word by a successor search
        relative to the context's own range."""
        step = 1 << 16  # a stretch of sorted queries stays in the processor's cache
        parts = [self._codes_of(context[a : a + step], word[a : a + step]) for a in range(0, len(context), step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint16)

    def _codes_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.zeros(len(context), np.uint16)
        if not self.contexts.n:
            return out
        c = np.minimum(self.contexts.successor(context), self.contexts.n - 1)
        w = np.minimum(self.vocabulary.successor(word), self.vocabulary.n - 1)
        known = np.flatnonzero((self.contexts.access(c) == context) & (self.vocabulary.access(w) == word))
        c, w = c[known], w[known]
        lo, hi = self.pointers.access(c).astype(np.int64), self.pointers.access(c + 1).astype(np.int64)
        base = np.where(lo > 0, self.values.access(np.maximum(lo - 1, 0)).astype(np.int64) + 1, 0)
        target = (base + w).astype(np.uint64)
        at = self.values.successor(target)
        inside = at < hi
        same = np.zeros(len(at), bool)
        same[inside] = self.values.access(at[inside]) == target[inside]
        out[known[same]] = self.codes[at[same]]
        return out

    def save(self, path: str) -> None:
        """One file: a header, then the levels."""
        parts, arrays = [], []
        for ef in (self.vocabulary, self.contexts, self.pointers, self.values):
            parts.append([ef.n, ef.low_bits, len(ef.low), len(ef.high)])
            arrays += [ef.low, ef.high]
        head = json.dumps({"sequences": parts, "codes": len(self.codes)}).encode()
        with open(path, "wb") as f:
            f.write(len(head).to_bytes(8, "little") + head + b" " * (-len(head) % 8))
            for a in [*arrays, self.codes]:
                f.write(np.ascontiguousarray(a).tobytes())

    @classmethod
    def load(cls, path: str) -> Trie:
        """The levels as memory maps: pages are read as queries touch them."""
        with open(path, "rb") as f:
            size = int.from_bytes(f.read(8), "little")
            head = json.loads(f.read(size))
        at, sequences = 8 + size + -size % 8, []
        raw = np.memmap(path, np.uint8, "r")

        def cut(n: int, kind) -> np.ndarray:
            nonlocal at
            out = raw[at : at + n * np.dtype(kind).itemsize].view(kind)
            at += n * np.dtype(kind).itemsize
            return out

        for n, bits, low, high in head["sequences"]:
            sequences.append(EliasFano(n, bits, cut(low, np.uint64), cut(high, np.uint64)))
        return cls(*sequences, cut(head["codes"], np.uint16))
