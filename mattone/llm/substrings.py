"""Passages that occur again: every stretch of WINDOW words that stands earlier in the corpus is found, and its words removed.

Only what can repeat is indexed.  The windows of a text that share their anchor - the least hash among the sequences of ANCHOR
words inside a window - form a piece, and equal windows have equal anchors, so a window may repeat only if its anchor
occurs twice in the corpus.  Pieces of such anchors are dealt by anchor, and each task cuts what it gets into shards of whole
anchors: a compressed FM-index of the shard's pieces, through which the pieces are streamed.  Backward search gives
the matching statistics; each window that matches with WINDOW words is compared with the earliest of the places in its
suffix interval, and intervals of windows that stand earlier are reported.

The few anchors with the most pieces are looked up by a broadcast of bounded size, not by a shuffle.
An anchor with more than SPREAD pieces is dealt in parts of about that many, by a hash of the piece.  Windows that none of a
part's other pieces repeats are first in their part; they, at most one per window and part, meet again in a second search,
dealt by a hash of the whole window.  So no group grows with the copies of a passage, and no pair of copies is ever listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mattone.llm.arrays import Words, slices
from mattone.llm.fm_index import SEPARATOR, FMIndex
from mattone.llm.scratch import written, written_alone

WINDOW = 20
ANCHOR = 6
# Windows of a piece; longer stretches of one anchor, as in periodic texts, are cut.
PIECE = 16
SPREAD = 2048
# So many anchors at most are broadcast as hot ones.
HOT = 1_000_000
# A shard is closed at the first anchor behind so many words.
SHARD_WORDS = 1 << 19

_FIRST = np.iinfo(np.int64).min


def _pieces(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, windows, anchor, periodic) of the pieces of some texts; starts count words inside the text.

    A piece whose own windows may be equal, as one of its short sequences comes again within PIECE words, is periodic.
    """
    count = np.diff(words.first)
    hashes, _, _ = words.shingles(ANCHOR)
    again = np.zeros(len(hashes), bool)
    for distance in range(1, min(PIECE, len(hashes))):
        again[:-distance] |= hashes[:-distance] == hashes[distance:]
    before = np.append(0, np.cumsum(again))
    inside = WINDOW - ANCHOR + 1
    width = 1
    while 2 * width <= inside:
        hashes = np.minimum(hashes, np.append(hashes[width:], hashes[-width:])) if len(hashes) > width else hashes
        width *= 2
    rest = inside - width
    if rest and len(hashes) > rest:
        hashes = np.minimum(hashes, np.append(hashes[rest:], hashes[-rest:]))
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(text)) - np.repeat(words.first[:-1], count)
    here = np.flatnonzero(place + WINDOW <= np.repeat(count, count))
    if not len(here):
        return here, here, here, hashes[:0], again[:0]
    text, place, least = text[here], place[here], hashes[here]
    begins = np.append(True, (text[1:] != text[:-1]) | (least[1:] != least[:-1]))
    run = np.arange(len(here)) - np.maximum.accumulate(np.where(begins, np.arange(len(here)), 0))
    first = np.flatnonzero(begins | (run % PIECE == 0))
    windows = np.diff(np.append(first, len(here)))
    periodic = before[here[first] + windows + inside - 1] > before[here[first]]
    return text[first], place[first], windows, least[first], periodic


def anchors(documents: DataFrame) -> DataFrame:
    """(anchor, doc_id, row, place) of every piece of ``documents(doc_id, row, text)``.

    ``place`` is ``start * 256 + windows * 4 + n``, where n is 2 if the piece's own windows may be equal, else 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            text, start, windows, anchor, periodic = _pieces(Words.of(piece.column("text"), lower=False))
            own = pa.array(text, pa.int64())
            columns = [pa.array(anchor.view(np.int64)), piece.column("doc_id").take(own), piece.column("row").take(own), pa.array(start * 256 + windows * 4 + 1 + periodic, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "doc_id", "row", "place"])

    return documents.select("doc_id", "row", "text").mapInArrow(run, "anchor long, doc_id long, row int, place long")


PIECES = "key long, part long, parts long, doc_id long, row int, start long, words binary"


def _with_words(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of the pieces that ``wanted(doc_id, row, pieces)`` names."""
    asked = wanted.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "pieces")
    joined = documents.join(asked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))).select("doc_id", "row", "text", "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            words = Words.of(piece.column("text"), lower=False)
            lists = piece.column("pieces")
            asked = lists.flatten()
            own = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            numbers = {name: asked.field(name).to_numpy(zero_copy_only=False) for name in ("key", "part", "parts", "start", "windows")}
            first = words.first[own] + numbers["start"]
            low, high = words.start[first].tolist(), words.end[first + numbers["windows"] + WINDOW - 2].tolist()
            raw = words.data.tobytes()
            # Some pieces at a time: overlapping ones hold more bytes than their text.
            for i in range(0, len(low), 8192):
                part = slice(i, i + 8192)
                take = pa.array(own[part], pa.int64())
                columns = [pa.array(numbers[n][part]) for n in ("key", "part", "parts")]
                columns += [piece.column("doc_id").take(take), piece.column("row").take(take), pa.array(numbers["start"][part])]
                columns.append(pa.array([raw[a:b] for a, b in zip(low[part], high[part])], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["key", "part", "parts", "doc_id", "row", "start", "words"])

    return joined.mapInArrow(run, PIECES)


class _Shard:
    """Pieces of whole keys, searched together; equal ones are indexed and streamed once, at their first place."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.rows: list[tuple[int, int | None, int, int, int]] = []
        self.size = 0

    def add(self, doc_id: int | None, row: int, start: int, parts: int, words: bytes) -> None:
        piece = self.known.setdefault(words, len(self.known))
        if piece == len(self.known) - 1:
            self.size += len(words) // 6
        self.rows.append((piece, doc_id, row, start, parts))

    def search(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """(row, window, repeated) of all windows of the shard's rows, repeated if they stand earlier in some piece; and the words of each piece."""
        cut = [w.split() for w in self.known]
        numbers: dict[bytes, int] = {}
        count = np.array([len(w) for w in cut], np.int64)
        begin = np.append(0, np.cumsum(count + 1))[:-1]
        end = begin + count
        text = np.full(int(count.sum()) + len(count), SEPARATOR, np.int64)
        filled = np.ones(len(text), bool)
        filled[end] = False
        text[filled] = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for words in cut for w in words), np.int64, int(count.sum()))
        index, order = FMIndex.build(text, WINDOW)
        low, high = index.matches(text, begin, end)

        own = np.array([r[0] for r in self.rows], np.int64)
        ids = np.array([_FIRST if r[1] is None else r[1] for r in self.rows], np.int64)
        starts = np.array([r[3] for r in self.rows], np.int64)
        by = np.lexsort((starts, ids, own))
        first = by[np.append(True, own[by][1:] != own[by][:-1])]
        # Windows of the pieces at their first places, by document, then start.
        windows = np.maximum(count - WINDOW + 1, 0)
        piece, window = _ranges(windows)
        at = begin[piece] + window
        place = np.stack([ids[first][piece], starts[first][piece] + window])
        by = np.lexsort(place[::-1])
        rank = np.full(len(text) + 1, len(text), np.int64)
        rank[at[by]] = np.arange(len(by))
        # reduceat reads pairs of bounds; what lies between pairs is left out.
        bounds = np.stack([low[at], high[at]], axis=1).reshape(-1)
        best = np.minimum.reduceat(np.append(rank[order], len(text)), bounds)[::2] if len(at) else at
        earliest = place[:, by[best]] if len(at) else place

        row, window = _ranges(windows[own])
        of = (np.append(0, np.cumsum(windows)[:-1]))[own][row] + window
        doc, start = ids[row], starts[row] + window
        repeated = (earliest[0][of] < doc) | (earliest[0][of] == doc) & (earliest[1][of] < start)
        return row, window, repeated, cut


def _ranges(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, k) for every k below count[i]."""
    which = np.repeat(np.arange(len(count)), count)
    return which, np.arange(len(which)) - np.repeat(np.append(0, np.cumsum(count)[:-1]), count)


FOUND = "doc_id long, row int, begin long, stop long, words binary"


def search(pieces: DataFrame) -> DataFrame:
    """Intervals ``begin`` to ``stop`` (exclusive) of words in windows that stand earlier in a piece of the same key and part; and, of keys
    dealt in several parts, the windows that do not, with their words."""

    def found(shard: _Shard) -> Iterator[pa.RecordBatch]:
        at, window, repeated, cut = shard.search()
        edge = np.append(True, at[1:] != at[:-1]) if len(at) else repeated
        begins = np.flatnonzero(repeated & (edge | ~np.append(False, repeated[:-1])))
        stops = np.flatnonzero(repeated & (np.append(edge[1:], True) | ~np.append(repeated[1:], False)))
        rows = []
        for k, a, b in zip(at[begins].tolist(), window[begins].tolist(), window[stops].tolist()):
            _, doc_id, row, start, _ = shard.rows[k]
            rows.append((doc_id, row, start + a, start + b + WINDOW, None))
        dealt = np.array([r[4] > 1 for r in shard.rows], bool)[at]
        once = np.flatnonzero(~repeated & dealt)
        for k, i in zip(at[once].tolist(), window[once].tolist()):
            piece, doc_id, row, start, _ = shard.rows[k]
            rows.append((doc_id, row, start + i, start + i + WINDOW, b" ".join(cut[piece][i : i + WINDOW])))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "row", "begin", "stop", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = _Shard(), None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                key, part, parts, doc_id, own, start, words = row
                if (key, part) != last:
                    if shard.size >= SHARD_WORDS:
                        yield from found(shard)
                        shard = _Shard()
                    last = (key, part)
                shard.add(doc_id, own, start, parts, words)
        if shard.rows:
            yield from found(shard)

    dealt = pieces.repartition("key", "part").sortWithinPartitions("key", "part")
    return dealt.mapInArrow(run, FOUND)


def repeated_intervals(documents: DataFrame) -> DataFrame:
    """(doc_id, row, begin, stop): stretches of words of ``documents(doc_id, row, text)`` that are covered by windows that stand earlier."""
    placed = written(anchors(documents), "anchors")
    counts = written_alone(placed.groupBy("anchor").agg(F.sum(F.col("place") % 4).alias("n")).where("n > 1"), "anchor-counts")
    # At most HOT anchors have so many pieces; theirs are not shuffled by anchor.
    limit = max(SPREAD, placed.count() * 2 // HOT)
    hot, rest = F.broadcast(counts.where(F.col("n") > limit)), counts.where(F.col("n") <= limit)
    counted = placed.join(hot, "anchor").unionByName(placed.join(hot, "anchor", "left_anti").join(rest, "anchor"))
    parts = F.ceil(F.col("n") / SPREAD)
    start, windows = F.shiftright("place", 8), F.shiftright("place", 2) % 64
    where = F.pmod(F.xxhash64("doc_id", "row", "place"), parts)
    named = F.struct(F.col("anchor").alias("key"), where.alias("part"), parts.alias("parts"), start.alias("start"), windows.alias("windows"))
    wanted = written_alone(counted.groupBy("doc_id", "row").agg(F.collect_set(named).alias("pieces")), "wanted")
    once = written_alone(search(_with_words(documents, wanted)), "first-search")
    again = once.where("words is not null").select(
        F.xxhash64("words").alias("key"), F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), "doc_id", "row", F.col("begin").alias("start"), "words"
    )
    return once.where("words is null").drop("words").unionByName(search(again).drop("words"))


def remove_repeated(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: its words without those in a window of WINDOW words that stands earlier, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+`` as they are.  Earlier is a smaller doc_id, or an earlier start in the same document; windows are judged
    on the texts as given.  Rows without a doc_id come before all others and count as one document, as do several rows of one
    doc_id: windows at the same start of such rows do not remove each other.  Null and empty texts have no words; an
    empty table gives an empty one; other columns are ignored, whatever their names.
    """
    marked = documents.select("doc_id", "text", F.hash("text").alias("row"))
    intervals = repeated_intervals(marked)
    lists = written_alone(intervals.groupBy("doc_id", "row").agg(F.collect_set(F.struct("begin", "stop")).alias("cuts")), "repeated")
    cuts = lists.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "cuts")
    joined = marked.join(cuts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left").select("doc_id", "text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            n_words, n_removed, kept = [], [], []
            for raw, found in zip(piece.column("text").cast(pa.binary()).to_pylist(), piece.column("cuts").to_pylist()):
                words = raw.split() if raw else []
                n_words.append(len(words))
                if found:
                    keep = np.ones(len(words), bool)
                    for cut in found:
                        keep[cut["begin"] : cut["stop"]] = False
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            columns = [piece.column("doc_id").cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
