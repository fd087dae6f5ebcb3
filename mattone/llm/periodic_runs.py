"""Periodic runs in the word sequences of texts: stretches in which some words repeat over and over.

A run is a stretch of consecutive words with smallest period q, at least ``max(LEAST, TIMES * q)`` words long, that no
neighbouring word extends keeping that period.  The suffixes of a text are sorted by doubling; neighbours in that order with a longest
common prefix (LCP) are the edges of a tree that Kruskal's algorithm builds by decreasing LCP.  Each class of united suffixes
keeps its positions in order.  Two positions that become neighbours at distance q when classes of LCP l unite begin
``q + l`` words of period q.

Why this finds each run once and nothing else: for a run of n >= 4q words from s, the suffixes s and s + q share n - q >= 3q words.  A position between them in
their class would give the stretch a period below q, so they become neighbours just when their classes unite, at l = n - q.
By the same argument neighbours at distance q with l >= 3q have no smaller period.  Positions inside a run show it again
and are told from its start by the word before, which the period would extend.  Only LCPs of LEAST - 1 and more can seed
a run, so suffixes whose first four words are unique in the text leave before the long part.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mattone.llm.arrays import slices

LEAST = 6
TIMES = 4
# Positions of the smaller of two classes up to which they are inserted one by one.
FEW = 16

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _refined(ids: np.ndarray, most: int) -> list[np.ndarray]:
    """Dense ranks of the sequences of 1, 2, 4, ... ``most`` words that begin at each position, 0 behind the end."""
    n = len(ids)
    levels = [np.append(ids + 1, 0)]
    width = 1
    while width < most:
        now = levels[-1]
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = now[width:n]
        _, rank = np.unique(now[:n] * (int(now.max()) + 1) + after, return_inverse=True)
        levels.append(np.append(rank + 1, 0))
        width *= 2
    return levels


def repeated_suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): the suffixes by their first four words, those that share them sorted to the end; ``lcp[k]`` is the
    number of words that suffixes k and k + 1 share, 0 where it is below four."""
    n = len(ids)
    levels = _refined(ids, 4)
    four = levels[-1][:n]
    order = np.argsort(four, kind="stable")
    groups = four[order]
    begins = np.append(True, groups[1:] != groups[:-1])
    active = np.flatnonzero(~(begins & np.append(begins[1:], True)))
    if not len(active):
        return active, active
    # From here a rank is the place of its group's first suffix.
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(n), 0)) + 1
    levels[-1] = rank
    width = 4
    while True:
        now = levels[-1]
        own = now[order[active]]
        after = now[np.minimum(order[active] + width, n)]
        by = np.lexsort((after, own))
        own, after = own[by], after[by]
        order[active] = order[active][by]
        group = np.append(True, own[1:] != own[:-1])
        part = group | np.append(True, after[1:] != after[:-1])
        places = np.arange(len(active))
        # Inside its old group a new one begins as far on as it does in this sorting.
        offset = np.maximum.accumulate(np.where(part, places, 0)) - np.maximum.accumulate(np.where(group, places, 0))
        fresh = now.copy()
        fresh[order[active]] = own + offset
        levels.append(fresh)
        width *= 2
        ends = np.append(part[1:], True)
        active = active[~(part & ends)]
        if not len(active):
            break
    inside = np.flatnonzero(levels[2][order[:-1]] == levels[2][order[1:]])
    left, right = order[inside], order[inside + 1]
    shared = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][left + shared] == levels[k][right + shared]
        shared[same] += 1 << k
    lcp = np.zeros(n - 1, np.int64)
    lcp[inside] = shared
    return order, lcp


def word_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start, then period."""
    if len(ids) < LEAST:
        return []
    order, lcp = repeated_suffixes(ids)
    edges = np.flatnonzero(lcp >= LEAST - 1)
    if not len(edges):
        return []
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    # Classes of suffixes by their place in the order; only places at an edge are ever asked for.
    places = np.union1d(edges, edges + 1)
    at = dict(zip(places.tolist(), range(len(places))))
    parent = list(range(len(places)))
    sets: list[list[int]] = [[p] for p in order[places].tolist()]

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    seeds: list[tuple[int, int, int]] = []
    for edge, shared in zip(edges.tolist(), lcp[edges].tolist()):
        a, b = root(at[edge]), root(at[edge + 1])
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large, small = sets[a], sets[b]
        far = shared // (TIMES - 1)
        last = len(small) - 1
        for k, p in enumerate(small):
            i = bisect_left(large, p)
            # Neighbours in the united class: no other new position lies between.
            if i and p - large[i - 1] <= far and (k == 0 or small[k - 1] < large[i - 1]):
                seeds.append((large[i - 1], p - large[i - 1], shared))
            if i < len(large) and large[i] - p <= far and (k == last or small[k + 1] > large[i]):
                seeds.append((p, large[i] - p, shared))
        if len(small) <= FEW:
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()
        parent[b] = a
        sets[b] = []
    found = [(s, q + shared, q) for s, q, shared in seeds if q + shared >= max(LEAST, TIMES * q) and (s == 0 or ids[s - 1] != ids[s - 1 + q])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def find_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs by start, then period, and its words without those that stand
    in a run behind the run's first period, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``, told apart by their bytes.  A null text has no words and no runs, ``collapsed`` is
    empty; rows without a doc_id and repeated rows are read like any other, each for itself; an empty table gives an empty one; other columns are
    ignored, whatever their names.  No text is cut; the work of a text of n words is sorting its repeated suffixes a
    logarithmic number of times, and nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            n_words, runs, collapsed = [], [], []
            for raw in piece.column("text").cast(pa.binary()).to_pylist():
                words = raw.split() if raw else []
                known: dict[bytes, int] = {}
                ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
                found = word_runs(ids)
                if found:
                    keep = np.ones(len(words), bool)
                    for start, length, period in found:
                        keep[start + period : start + length] = False
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                n_words.append(len(ids))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                collapsed.append(b" ".join(words))
            columns = [piece.column("doc_id").cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(runs, _RUN), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return documents.select("doc_id", "text").mapInArrow(run, RUNS)
