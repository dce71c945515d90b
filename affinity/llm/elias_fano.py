"""Elias-Fano coded monotone sequences and a two-level n-gram trie over them.

A sorted sequence of m numbers below u takes about 2 + log2(u / m) bits each:
the lower bits packed, the upper bits in unary. ``find`` answers many
successor searches at once: a select on the upper bits gives the range of the
numbers that share the key's upper part, a binary search on the lower bits
finishes. The serialised form can be read from a memory-mapped file.
"""

from __future__ import annotations

import tempfile

import numpy as np

STEP = 64  # probabilities are kept as multiples of 1/STEP of a decade


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` lower bits of each value, little-endian, with room for an 8-byte read at the end."""
    out = []
    for at in range(0, len(values), 1 << 16):  # whole bytes as the chunk is a multiple of 8
        part = values[at:at + (1 << 16), None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)
        out.append(np.packbits(part.astype(np.uint8).ravel(), bitorder="little"))
    return np.concatenate([*out, np.zeros(16, np.uint8)])


class EliasFano:
    def __init__(self, size: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.size, self.bits, self.low, self.high, self.ones = size, bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> "EliasFano":
        """``values``: sorted, below ``universe``."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = max(0, min(56, int(universe // max(n, 1)).bit_length() - 1))
        upper = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        length = (int(upper[-1]) if n else 0) + 2
        unary = np.zeros(-(-length // 64) * 64, np.uint8)
        unary[upper] = 1
        high = np.packbits(unary, bitorder="little")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high.view("<u8")).astype(np.int64))])
        return cls(n, bits, _pack(values & np.uint64((1 << bits) - 1), bits) if bits else np.zeros(16, np.uint8), high, ones)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.size, self.bits], np.int64), self.low, self.high, self.ones.astype(np.int64)]

    @classmethod
    def from_parts(cls, parts: list[np.ndarray]) -> "EliasFano":
        head = parts[0].view(np.int64)
        return cls(int(head[0]), int(head[1]), parts[1], parts[2], parts[3].view(np.int64))

    def _select0(self, j: np.ndarray) -> np.ndarray:
        """Place of the j-th zero (from 0) of the unary part; its end beyond the last one."""
        word = np.searchsorted(self.zeros, j, side="right") - 1
        out = np.full(len(j), len(self.high) * 8, np.int64)
        inside = np.flatnonzero(word < len(self.high) // 8)
        rows = self.high.reshape(-1, 8)
        for at in range(0, len(inside), 1 << 16):
            i = inside[at:at + (1 << 16)]
            free = 1 - np.unpackbits(rows[word[i]], axis=1, bitorder="little")
            rank = np.cumsum(free, axis=1, dtype=np.uint8)
            want = (j[i] - self.zeros[word[i]] + 1).astype(np.uint8)
            out[i] = word[i] * 64 + (rank >= want[:, None]).argmax(axis=1)
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.bits
        words = np.ndarray((len(self.low) - 7,), "<u8", np.ascontiguousarray(self.low), strides=(1,))
        return words[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.bits) - 1)

    def successor(self, keys: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of the first value that is not below each key (the size if
        none); with ``first`` and ``last``, among the values from the one index to
        before the other (``last`` if none)."""
        keys = np.asarray(keys, np.uint64)
        if not self.size:
            return np.zeros(len(keys), np.int64)
        upper = (keys >> np.uint64(self.bits)).astype(np.int64)
        low = (keys & np.uint64((1 << self.bits) - 1)) if self.bits else np.zeros(len(keys), np.uint64)
        begin = np.where(upper > 0, self._select0(np.maximum(upper - 1, 0)) - upper + 1, 0)
        end = np.minimum(self._select0(upper) - upper, self.size)
        if first is not None:
            begin, end = np.maximum(begin, first), np.minimum(end, last)
            begin = np.where(begin >= last, last, begin)
        begin = np.minimum(begin, end) if first is None else begin
        while True:
            open_ = np.flatnonzero(begin < end)
            if not len(open_):
                return begin
            mid = (begin[open_] + end[open_]) >> 1
            less = self._low(mid) < low[open_]
            begin[open_[less]] = mid[less] + 1
            end[open_[~less]] = mid[~less]

    def values(self, i: np.ndarray) -> np.ndarray:
        """The values at sorted or unsorted indexes."""
        if not len(i):
            return np.zeros(0, np.uint64)
        word = np.searchsorted(self.ones, i, side="right") - 1
        out = np.empty(len(i), np.int64)
        rows = self.high.reshape(-1, 8)
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            rank = np.cumsum(np.unpackbits(rows[word[s]], axis=1, bitorder="little"), axis=1, dtype=np.uint8)
            out[s] = word[s] * 64 + (rank >= (i[s] - self.ones[word[s]] + 1).astype(np.uint8)[:, None]).argmax(axis=1)
        return (out - i).astype(np.uint64) << np.uint64(self.bits) | self._low(np.asarray(i, np.int64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or -1."""
        keys = np.asarray(keys, np.uint64)
        at = self.successor(keys)
        inside = np.flatnonzero(at < self.size)
        out = np.full(len(keys), -1, np.int64)
        same = self.values(at[inside]) == keys[inside]
        out[inside[same]] = at[inside[same]]
        return out


class BigramTrie:
    """Two levels: contexts with monotone pointers to their successors, and the
    successors with quantised log10 probabilities. Words are numbers below
    2**64 and 2**48; both levels name them by rank, a successor relative to
    its context (rank of the context * successors known + rank)."""

    NAMES = ("contexts", "pointers", "words", "pairs")

    def __init__(self, **levels):
        self.__dict__.update(levels)

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, log10p: np.ndarray) -> "BigramTrie":
        """Pairs sorted by (context, word), each once."""
        contexts, first = np.unique(context, return_index=True)
        words, rank = np.unique(word, return_inverse=True)
        n = max(len(words), 1)
        rel = np.repeat(np.arange(len(contexts)), np.diff(np.append(first, len(context)))) * n + rank
        return cls(contexts=EliasFano.build(contexts, 1 << 64), pointers=EliasFano.build(first, len(context) + 1),
                   words=EliasFano.build(words, 1 << 48), pairs=EliasFano.build(rel, len(contexts) * n + 1),
                   codes=np.clip(np.rint(-log10p * STEP), 0, 65535).astype("<u2"))

    def to_file(self, f) -> None:
        parts = [p for name in self.NAMES for p in getattr(self, name).parts()] + [self.codes]
        f.write(np.array([len(parts), *[p.nbytes for p in parts]], np.int64).tobytes())
        for p in parts:
            f.write(np.ascontiguousarray(p).tobytes() + b"\0" * (-p.nbytes % 8))
        f.flush()

    @classmethod
    def from_file(cls, f) -> "BigramTrie":
        raw = np.memmap(f, np.uint8, "r")
        count = int(raw[:8].view(np.int64)[0])
        sizes = raw[8:8 + 8 * count].view(np.int64)
        parts, at = [], 8 + 8 * count
        for size in sizes.tolist():
            parts.append(raw[at:at + size])
            at += size + -size % 8
        levels = {name: EliasFano.from_parts(parts[4 * i:4 * i + 4]) for i, name in enumerate(cls.NAMES)}
        return cls(codes=parts[-1].view("<u2"), **levels)

    @classmethod
    def mapped(cls, *pairs) -> "BigramTrie":
        """Built, written to an unnamed temporary file and mapped from there."""
        with tempfile.TemporaryFile() as f:
            cls.build(*pairs).to_file(f)
            return cls.from_file(f)

    def successors(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the successors of each context; empty for an unknown one."""
        c = self.contexts.find(context)
        known = np.maximum(c, 0)
        if not self.contexts.size:
            return np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
        begin = self.pointers.values(known).astype(np.int64)
        last = known + 1 >= self.pointers.size
        end = np.where(last, self.pairs.size, self.pointers.values(np.minimum(known + 1, self.pointers.size - 1)).astype(np.int64))
        return begin, np.where(c < 0, begin, end)

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes (-log10 p * STEP) of pairs, or -1: each context leads through
        its pointers to its own successors, and the word is searched among them.
        The pairs of a context should stand together; it is found once then."""
        out = np.full(len(context), -1, np.int64)
        if not len(context) or not self.contexts.size:
            return out
        head = np.append(True, context[1:] != context[:-1])
        run = np.cumsum(head) - 1
        begin, end = (x[run] for x in self.successors(context[head]))
        w = self.words.find(word)
        ok = np.flatnonzero((begin < end) & (w >= 0))
        rank = self.contexts.find(context[head])[run[ok]]
        key = rank.astype(np.uint64) * np.uint64(self.words.size) + w[ok].astype(np.uint64)
        at = self.pairs.successor(key, begin[ok], end[ok])
        inside = at < end[ok]
        ok, at, key = ok[inside], at[inside], key[inside]
        same = self.pairs.values(at) == key
        out[ok[same]] = self.codes[at[same]]
        return out
