"""Monotone sequences in few bits (Elias-Fano), and an n-gram trie made of them in one mapped file."""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np

from lakeweir.llm.common import U

ONE, WORD_BITS = U(1), 64


def select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit with ``rank`` set bits below it, for each 64-bit word."""
    rest, left = words.copy(), rank.astype(np.int64)
    place = np.zeros(len(words), dtype=np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(rest & U((1 << width) - 1)).astype(np.int64)
        up = left >= below
        left -= below * up
        rest >>= (up * width).astype(U)
        place += up * width
    return place


class EliasFano:
    """A non-decreasing sequence of unsigned numbers.

    Each number's low bits are packed; its high bits are a run of zeros before a one in a bit
    vector, on which counts per word give select. All arrays may be mapped from a file.
    """

    FIELDS = ("shape", "low", "high", "ones")

    def __init__(self, shape: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.shape, self.low, self.high, self.ones = shape, low, high, ones
        self.n, self.bits = int(shape[0]), int(shape[1])

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = np.zeros((n * bits >> 6) + 2, dtype=U)
        if n and bits:
            part = values & U((1 << bits) - 1)
            at = np.arange(n, dtype=np.int64) * bits
            word, shift = at >> 6, (at & 63).astype(U)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            low[word[first]] = np.bitwise_or.reduceat(part << shift, first)
            over = np.flatnonzero(shift + U(bits) > U(WORD_BITS))
            low[word[over] + 1] |= part[over] >> (U(WORD_BITS) - shift[over])
        size = n + (top >> bits) + 1
        flags = np.zeros(-(-size // WORD_BITS) * WORD_BITS, dtype=np.uint8)
        flags[(values >> U(bits)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(U)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls(np.array([n, bits, top >> bits], dtype=np.int64), low, high, ones)

    def lows(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), dtype=U)
        first = at.astype(np.int64) * self.bits
        word, shift = first >> 6, (first & 63).astype(U)
        # Shifting in two steps, as 64 is no valid distance.
        after = (self.low[word + 1] << ONE) << (U(63) - shift)
        return ((self.low[word] >> shift) | after) & U((1 << self.bits) - 1)

    def ends(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have at most these high bits: the place of the zero after them, less the zeros."""
        high = np.minimum(high, int(self.shape[2]) if self.n else 0).astype(np.int64)
        zeros = np.arange(len(self.ones)) * WORD_BITS - self.ones
        word = np.minimum(np.searchsorted(zeros, high, side="right") - 1, len(self.high) - 1)
        place = word * WORD_BITS + select_in_word(~self.high[word], high - zeros[word])
        # Beyond the last number all bits are zeros, so the sequence's end is the limit.
        return np.minimum(place - high, self.n)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, dtype=np.int64)
        word = np.searchsorted(self.ones, at, side="right") - 1
        place = word * WORD_BITS + select_in_word(self.high[word], at - self.ones[word])
        return ((place - at).astype(U) << U(self.bits)) | self.lows(at)

    def successor(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Index of the first number that is not below each value within [first, last), else last.

        The high bits give a short run of candidates; their low bits are searched by halves.
        """
        if not self.n:
            return last.copy()
        top = int(self.shape[2])
        high = np.minimum(values >> U(self.bits), U(top + 1)).astype(np.int64)
        begin = np.where(high > 0, self.ends(np.maximum(high, 1) - 1), 0)
        end = self.ends(high)
        begin[high > top], end[high > top] = self.n, self.n
        begin, end = np.clip(begin, first, last), np.clip(end, first, last)
        want = values & U((1 << self.bits) - 1)
        active = np.flatnonzero(begin < end)
        while len(active):
            middle = (begin[active] + end[active]) >> 1
            less = self.lows(middle) < want[active]
            begin[active] = np.where(less, middle + 1, begin[active])
            end[active] = np.where(less, end[active], middle)
            active = active[begin[active] < end[active]]
        return begin


class Codes(NamedTuple):
    """Numbers in 16 bits: scale holds the least one and the step. Decoded values are not above the true ones,
    or not below them when ``up`` was asked for."""

    scale: np.ndarray
    code: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray, up: bool = False) -> Codes:
        low, high = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
        step = (high - low) / 65000 or 1.0
        place = (values - low) / step
        code = np.ceil(place - 1e-9) if up else np.floor(place + 1e-9)
        return cls(np.array([low, step]), code.astype(np.uint16))

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.scale[0] + self.code[at] * self.scale[1]


class Trie:
    """Two levels. A word's children are the words seen before it, so one range holds all contexts
    of a word: word hashes, where their children begin, child hashes, and quantised logarithms.

    Children are stored with their parent's place above CHILD_BITS bits of their hash, which makes
    the whole level monotone; a child is found as successor within its parent's range.
    """

    CHILD_BITS = 40
    PARTS = ("words", "firsts", "children", "single", "context", "pair")

    def __init__(self, words: EliasFano, firsts: EliasFano, children: EliasFano, single: Codes, context: Codes, pair: Codes):
        self.words, self.firsts, self.children = words, firsts, children
        self.single, self.context, self.pair = single, context, pair

    def find_words(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word, or -1."""
        n = len(hashes)
        at = self.words.successor(hashes, np.zeros(n, np.int64), np.full(n, self.words.n))
        return self._exact(self.words, at, hashes)

    def find_children(self, parents: np.ndarray, children: np.ndarray) -> np.ndarray:
        """Place of each child below its parent (a place of a word, or -1), or -1."""
        out = np.full(len(parents), -1, dtype=np.int64)
        known = np.flatnonzero(parents >= 0)
        parent = parents[known]
        first, last = self.firsts[parent].astype(np.int64), self.firsts[parent + 1].astype(np.int64)
        want = (parent.astype(U) << U(self.CHILD_BITS)) | children[known]
        out[known] = self._exact(self.children, self.children.successor(want, first, last), want)
        return out

    @staticmethod
    def _exact(level: EliasFano, at: np.ndarray, want: np.ndarray) -> np.ndarray:
        if not level.n:
            return np.full(len(want), -1, dtype=np.int64)
        return np.where((at < level.n) & (level[np.minimum(at, level.n - 1)] == want), at, -1)

    def save(self, path: str) -> None:
        """One file: a line that lists the arrays, then the arrays, each at a multiple of 64 octets."""
        arrays, entries, at = [], [], 0
        for part in self.PARTS:
            value = getattr(self, part)
            for field in value.FIELDS if isinstance(value, EliasFano) else value._fields:
                array = np.ascontiguousarray(getattr(value, field))
                entries.append([part, field, array.dtype.str, len(array), at])
                arrays.append(array)
                at += -(-array.nbytes // 64) * 64
        line = json.dumps(entries).encode()
        line = line.ljust(-(-(len(line) + 1) // 64) * 64 - 1) + b"\n"
        with open(path, "wb") as out:
            out.write(line)
            for array in arrays:
                out.write(array.tobytes().ljust(-(-array.nbytes // 64) * 64, b"\0"))

    @classmethod
    def open(cls, path: str) -> Trie:
        """Mapped, not read: pages come in as queries touch them."""
        with open(path, "rb") as file:
            line = file.readline()
        data = np.memmap(path, dtype=np.uint8, mode="r")
        parts: dict[str, dict[str, np.ndarray]] = {}
        for part, field, kind, n, at in json.loads(line):
            begin = len(line) + at
            parts.setdefault(part, {})[field] = data[begin : begin + n * np.dtype(kind).itemsize].view(kind)
        return cls(*[(EliasFano if "ones" in parts[p] else Codes)(**parts[p]) for p in cls.PARTS])
