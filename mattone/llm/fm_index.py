"""A compressed FM-index over the words of some passages: backward search and matching statistics.

The Burrows-Wheeler transform of the passages is kept as a wavelet tree laid out level by level: one bit plane per bit of
a word's number, 64 positions to a machine word, with the set bits before each of them.  A backward step asks two ranks per
plane and needs neither the passages nor their suffixes.  Many passages are searched side by side, one step for all.

Matching statistics up to ``depth`` words are read from the right: a step to the left extends each match by a word; a match of
``depth`` words is reported and drops its last word, which widens its interval to the suffixes that share the other
words.  A bit plane marks where such classes of suffixes begin.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEPARATOR = 0


@dataclass
class Bits:
    """A bit plane with rank; ``before`` counts the set bits before each 64."""

    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, bits: np.ndarray) -> Bits:
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        words = packed.view("<u8")
        return cls(words, np.append(0, np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


def suffix_order(words: np.ndarray) -> np.ndarray:
    """Suffixes of a sequence of word numbers, sorted by doubling; each SEPARATOR ends its passage and sorts by its place."""
    n = len(words)
    ends = np.flatnonzero(words == SEPARATOR)
    rank = words + len(ends)
    rank[ends] = np.arange(len(ends))
    rank = np.unique(rank, return_inverse=True)[1]
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = rank[width:] + 1
        keys = rank * (n + 1) + after
        order = np.argsort(keys)
        fresh = np.append(0, np.cumsum(keys[order][1:] != keys[order][:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2


def same_prefix(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix shares ``depth`` words, none a SEPARATOR, with the one before it in the order."""
    left, right = order[:-1], order[1:]
    padded = np.append(words, np.zeros(depth, np.int64))
    same = np.ones(len(left), bool)
    for j in range(depth):
        live = np.flatnonzero(same)
        a = padded[left[live] + j]
        same[live] = (a == padded[right[live] + j]) & (a != SEPARATOR)
    return np.append(False, same) if len(words) else same


@dataclass
class FMIndex:
    """``first[c]`` counts the words below c; ``classes`` marks suffixes that share fewer than ``depth - 1`` words with the
    one before, ``begins`` lists them."""

    n: int
    depth: int
    planes: list[Bits]
    zeros: list[int]
    first: np.ndarray
    classes: Bits
    begins: np.ndarray

    @classmethod
    def build(cls, words: np.ndarray, depth: int) -> tuple[FMIndex, np.ndarray]:
        """The index of passages, each ended by SEPARATOR, and the order of their suffixes.  Words have numbers from 1."""
        order = suffix_order(words)
        before = words[order - 1]
        counts = np.bincount(words, minlength=1)
        bits = max(1, int(words.max()).bit_length())
        planes, zeros, now = [], [], before
        for b in range(bits - 1, -1, -1):
            bit = (now >> b & 1).astype(bool)
            planes.append(Bits.of(bit))
            zeros.append(len(now) - int(bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])
        breaks = ~same_prefix(words, order, depth - 1)
        first = np.append(0, np.cumsum(counts))
        return cls(len(words), depth, planes, zeros, first, Bits.of(breaks), np.append(np.flatnonzero(breaks), len(words))), order

    def rank(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each word stands before each position of the transform."""
        begin = np.zeros(len(at), np.int64)
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.rank(begin), plane.rank(at)
            one = (word >> (len(self.planes) - 1 - level) & 1).astype(bool)
            begin, at = np.where(one, zeros + a, begin - a), np.where(one, zeros + b, at - b)
        return at - begin

    def step(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the matches with ``word`` before them; empty where there is none."""
        both = self.rank(np.concatenate([word, word]), np.concatenate([low, high]))
        base = self.first[word]
        return base + both[: len(word)], base + both[len(word) :]

    def count(self, pattern: np.ndarray) -> int:
        """How often the words of ``pattern`` follow each other in the passages."""
        low, high = np.zeros(1, np.int64), np.full(1, self.n, np.int64)
        for word in pattern[::-1]:
            if not 0 < word < len(self.first) - 1:
                return 0
            low, high = self.step(np.array([word]), low, high)
        return max(0, int(high[0] - low[0]))

    def matches(self, passages: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each position of the passages ``begin`` to ``end``: the interval of suffixes that begin with the ``depth`` words from there
        on, empty where fewer match or are left.  Words the index does not hold have numbers beyond its own."""
        found_low, found_high = np.zeros(len(passages), np.int64), np.zeros(len(passages), np.int64)
        low, high = np.zeros(len(begin), np.int64), np.full(len(begin), self.n, np.int64)
        length, at = np.zeros(len(begin), np.int64), end - 1
        live = np.flatnonzero(at >= begin)
        while len(live):
            word = passages[at[live]]
            known = (word > 0) & (word < len(self.first) - 1)
            a, b = self.step(np.where(known, word, SEPARATOR), low[live], high[live])
            hit = known & (a < b)
            moved, lost = live[hit], live[~hit]
            low[moved], high[moved] = a[hit], b[hit]
            length[moved] += 1
            full = moved[length[moved] == self.depth]
            found_low[at[full]], found_high[at[full]] = low[full], high[full]
            # The match loses its last word: its interval becomes the class of suffixes that share the others.
            group = self.classes.rank(low[full] + 1) - 1
            low[full], high[full] = self.begins[group], self.begins[group + 1]
            length[full] -= 1
            at[moved] -= 1
            # Nothing that holds the failed stretch matches: the next match ends one word earlier.
            at[lost] += length[lost] - 1
            low[lost], high[lost], length[lost] = 0, self.n, 0
            live = live[at[live] >= begin[live]]
        return found_low, found_high
