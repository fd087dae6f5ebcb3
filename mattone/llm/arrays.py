"""The texts of an Arrow batch as flat numpy arrays: bytes, word spans, word and shingle hashes.

Tasks work on slices of a few megabytes, so that memory does not grow with the
batch; one text is never cut.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[0x0A] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; grown as needed and kept by the worker."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n, SLICE_BYTES) + 1, base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = have = np.cumprod(steps, dtype=np.uint64)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets); a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces whose texts hold about ``most`` bytes; a longer text is a piece of its own.

    After the last one the worker gives back what it no longer needs.
    """
    yield from _cut(batches, column, most)
    give_back()


def give_back() -> None:
    """Return the free memory of this worker, which the next task of whatever step reuses, to the system."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def _cut(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin = total = 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += int(size)
        yield batch.slice(begin)


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts; those of text i are ``first[i]`` up to ``first[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, lower: bool, apart: np.ndarray = _SPACE) -> Words:
        """``apart`` flags the bytes that stand between words."""
        data, offsets = flat(texts)
        if lower:
            data = _LOWER[data]
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = ~apart[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        here = inside[1:-1]
        start = np.flatnonzero(here & (~inside[:-2] | edge[:-1]))
        end = np.flatnonzero(here & (~inside[2:] | edge[1:])) + 1
        return cls(data, offsets, start, end, np.searchsorted(start, offsets))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, from prefix sums of a polynomial modulo 2**64."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        n = len(self.data)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n)[:n], out=prefix[1:])
        return mix((prefix[self.end] - prefix[self.start]) * _power(_BASE_INVERSE, n)[self.start])

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, begin, end): shingles of text i are ``hashes[begin[i]:end[i]]``, repeats kept.

        A text with fewer words than ``width`` has its whole sequence as one shingle; one without words has none.
        """
        words = self.hashes()
        count = np.diff(self.first)
        rolled = np.zeros(len(words), np.uint64)
        full = len(words) - width + 1
        if full > 0:
            acc = words[:full].copy()
            for j in range(1, width):
                acc *= _STEP
                acc += words[j : j + full]
            rolled[:full] = mix(acc + np.uint64(width))
        for i in np.flatnonzero((count > 0) & (count < width)):
            acc = words[self.first[i]]
            with np.errstate(over="ignore"):
                for j in range(1, count[i]):
                    acc = acc * _STEP + words[self.first[i] + j]
                rolled[self.first[i]] = mix(np.array([acc + np.uint64(count[i])], np.uint64))[0]
        begin = self.first[:-1]
        return rolled, begin, begin + np.where(count >= width, count - width + 1, np.minimum(count, 1))
