"""Elias-Fano sequences on memory-mapped arrays, with vectorised successor search."""

from __future__ import annotations

from pathlib import Path

import numpy as np

_ONE = np.uint64(1)


def _stored(folder: Path, name: str, values: np.ndarray) -> np.ndarray:
    """Write an array and map it back; an empty one stays in memory."""
    if not len(values):
        return values
    np.save(folder / f"{name}.npy", values)
    return np.load(folder / f"{name}.npy", mmap_mode="r")


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """`bits`-wide numbers end to end in 64-bit words, one word to spare."""
    words = np.zeros(len(values) * bits // 64 + 2, dtype=np.uint64)
    if not bits or not len(values):
        return words
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    words[word[starts]] += np.add.reduceat(values << shift, starts)
    over = np.where(shift > 0, values >> ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    words[word[starts] + 1] += np.add.reduceat(over, starts)
    return words


class EliasFano:
    """A non-decreasing sequence of 64-bit numbers: low bits packed, high bits unary."""

    def __init__(self, values: np.ndarray, folder: Path, name: str) -> None:
        values = values.astype(np.uint64)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.bits = max(0, (top // max(1, self.n)).bit_length() - 1)
        low = np.uint64((1 << self.bits) - 1)
        self.lows = _stored(folder, f"{name}-low", _pack(values & low, self.bits))
        highs = (values >> np.uint64(self.bits)).astype(np.int64)
        marks = np.zeros((int(highs[-1]) if self.n else 0) + self.n + 65, dtype=np.uint8)
        marks[highs + np.arange(self.n)] = 1
        packed = np.packbits(marks, bitorder="little")
        packed = np.append(packed, np.zeros(-len(packed) % 8, dtype=np.uint8)).view(np.uint64)
        self.high = _stored(folder, f"{name}-high", packed)
        zeros = 64 - np.bitwise_count(packed).astype(np.int64)
        self.zeros = _stored(folder, f"{name}-zeros", np.cumsum(zeros))
        self.top = int(highs[-1]) if self.n else -1

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), dtype=np.uint64)
        bit = at.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        after = np.where(shift > 0, self.lows[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.lows[word] >> shift) | after) & np.uint64((1 << self.bits) - 1)

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many values have high bits below `high`: the ones before the zero that ends them."""
        k = np.minimum(high, self.top + 1) - 1
        asked = np.maximum(k, 0)
        word = np.searchsorted(self.zeros, asked, side="right")
        left = asked - np.where(word > 0, self.zeros[np.maximum(word, 1) - 1], 0)
        x, at = ~self.high[word], word.astype(np.int64) * 64
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(x & np.uint64((1 << width) - 1)).astype(np.int64)
            go = left >= count
            left = left - np.where(go, count, 0)
            x = np.where(go, x >> np.uint64(width), x)
            at = at + np.where(go, width, 0)
        return np.where(k < 0, 0, at - asked)

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value not below each wanted one, and whether it is equal to it."""
        if not self.n:
            return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
        wanted = wanted.astype(np.uint64)
        high = np.minimum(wanted >> np.uint64(self.bits), np.uint64(self.top + 1)).astype(np.int64)
        beyond = (wanted >> np.uint64(self.bits)) > np.uint64(self.top)
        begin, end = self._below(high), self._below(high + 1)
        low = wanted & np.uint64((1 << self.bits) - 1)
        a, b = begin.copy(), np.where(beyond, begin, end)
        while (a < b).any():
            middle = np.minimum((a + b) >> 1, self.n - 1)
            less = (a < b) & (self._low(middle) < low)
            b = np.where((a < b) & ~less, middle, b)
            a = np.where(less, middle + 1, a)
        found = (a < end) & ~beyond & (self._low(np.minimum(a, self.n - 1)) == low)
        return a, found

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at places, by the high bits' own order."""
        ones = np.cumsum(np.bitwise_count(np.asarray(self.high)).astype(np.int64))
        word = np.searchsorted(ones, at, side="right")
        left = at - np.where(word > 0, ones[np.maximum(word, 1) - 1], 0)
        x, bit = np.asarray(self.high)[word], word.astype(np.int64) * 64
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(x & np.uint64((1 << width) - 1)).astype(np.int64)
            go = left >= count
            left = left - np.where(go, count, 0)
            x = np.where(go, x >> np.uint64(width), x)
            bit = bit + np.where(go, width, 0)
        return ((bit - at).astype(np.uint64) << np.uint64(self.bits)) | self._low(at)
