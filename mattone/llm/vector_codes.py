"""Product codes of vectors: codebooks fitted by Lloyd's rounds that assign whole subtrees of cover trees.

Vectors are cut into equal consecutive parts, and each part position has a codebook of its own.  Every task groups its
vectors into blocks and grows one cover tree per block and part position, once: the children of a node are centres further apart than
the distance up to which they cover, the first one being the node's own centre, and each subtree is a stretch of the
block's vectors in tree order.  Running sums over that order give the sum of any subtree by one subtraction.

A round walks the trees from their roots with the entries that can still be nearest: if the nearest entry is at distance d from the
centre and the subtree reaches to r, an entry beyond ``d + 2r`` is nearest to no vector of it (triangle inequality).
A subtree left with one entry is assigned as a whole; only ambiguous nodes descend, and the vectors of ambiguous
leaves are compared exactly.  Entries at equal distance all stay, so ties go to the lowest index.

Components are whole numbers and every sum and squared distance is exact: floating point holds them while
they stay below 2**53, which the largest component decides; beyond it Python's whole numbers do.
Only sums per entry, as many numbers as the codebooks hold, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mattone.llm.scratch import small_side, written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
# Vectors of a block; a task holds one block and its trees at a time.
BLOCK = 4096
# Subtrees of so few vectors are leaves.
LEAF = 12
# A level covers this much less far than the one above.
SHRINK = 1.4
# Square roots are rounded; an entry is left out only if it is further by more than that.
SLACK = 1e-9
MOST = (1 << 63) - 1

BLOCKS = "vec_ids array<long>, labels array<long>, vectors binary, trees array<binary>"


@dataclass
class Tree:
    """A cover tree over one part of a block, its nodes level by level; the children of a node follow each other."""

    order: np.ndarray
    centre: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray
    radius: np.ndarray

    @classmethod
    def grow(cls, points: np.ndarray) -> Tree:
        """``points`` as floats; rounding can only make a radius too large by SLACK, never too small by more."""
        order = np.arange(len(points))
        nodes: list[list] = []
        far = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
        waiting = [(0, len(points), far)]
        at = 0
        while at < len(waiting):
            begin, end, far = waiting[at]
            at += 1
            radius = float(far.max())
            node = [int(order[begin]), begin, end, len(waiting), 0, radius]
            nodes.append(node)
            if end - begin <= LEAF or radius == 0:
                continue
            cover = radius / SHRINK
            rest, start = order[begin:end].copy(), begin
            while len(rest):
                near = far <= cover
                group = rest[near]
                order[start : start + len(group)] = group
                waiting.append((start, start + len(group), far[near]))
                node[4] += 1
                start += len(group)
                rest = rest[~near]
                if len(rest):
                    far = np.sqrt(((points[rest] - points[rest[0]]) ** 2).sum(axis=1))
        columns = list(zip(*nodes))
        return cls(order, *[np.array(c, np.int64) for c in columns[:5]], np.array(columns[5], np.float64))

    def to_bytes(self) -> bytes:
        head = np.array([len(self.order), len(self.centre)], "<i4").tobytes()
        whole = [self.order, self.centre, self.begin, self.end, self.child, self.children]
        return head + b"".join(a.astype("<i4").tobytes() for a in whole) + self.radius.astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> Tree:
        n, m = np.frombuffer(blob, "<i4", 2)
        numbers = np.frombuffer(blob, "<i4", n + 5 * m, 8).astype(np.int64)
        return cls(numbers[:n], *np.split(numbers[n:], 5), np.frombuffer(blob, "<f8", m, 8 + 4 * (n + 5 * m)))


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    if points.dtype == object:
        return np.array([[((p - e) ** 2).sum() for e in entries] for p in points], dtype=object).reshape(len(points), len(entries))
    return (points**2).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries**2).sum(axis=1)


def assign(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, entry) of the subtrees assigned as a whole, places and entries of the vectors compared one by one.

    ``points`` are in tree order.
    """
    place = np.empty(len(tree.order), np.int64)
    place[tree.order] = np.arange(len(tree.order))
    nodes, open_ = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
    whole: list[np.ndarray] = []
    single: list[np.ndarray] = []
    while len(nodes):
        far = np.sqrt(squares(points[place[tree.centre[nodes]]], entries).astype(np.float64))
        far[~open_] = np.inf
        bound = (far.min(axis=1) + 2 * tree.radius[nodes]) * (1 + SLACK) + SLACK
        open_ = far <= bound[:, None]
        sure = open_.sum(axis=1) == 1
        if sure.any():
            done = nodes[sure]
            whole.append(np.stack([tree.begin[done], tree.end[done], open_[sure].argmax(axis=1)]))
        nodes, open_ = nodes[~sure], open_[~sure]
        leaf = tree.children[nodes] == 0
        if leaf.any():
            count = tree.end[nodes[leaf]] - tree.begin[nodes[leaf]]
            at = np.repeat(tree.begin[nodes[leaf]] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
            exact = squares(points[at], entries)
            allowed = np.repeat(open_[leaf], count, axis=0)
            exact[~allowed] = exact.max() + 1 if exact.dtype == object else np.inf
            single.append(np.stack([at, exact.argmin(axis=1)]))
        nodes, open_ = nodes[~leaf], open_[~leaf]
        count = tree.children[nodes]
        nodes = np.repeat(tree.child[nodes] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
        open_ = np.repeat(open_, count, axis=0)
    begin, end, entry = np.concatenate(whole, axis=1) if whole else np.zeros((3, 0), np.int64)
    at, chosen = np.concatenate(single, axis=1) if single else np.zeros((2, 0), np.int64)
    return begin, end, entry, at, chosen


@dataclass
class Codebooks:
    """Per part position the entries as whole numbers; ``exact`` tells that floating point holds all sums."""

    entries: list[np.ndarray]
    exact: bool

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for part in self.entries for x in part.reshape(-1)).encode()).hexdigest()

    def numbers(self, part: int) -> np.ndarray:
        return self.entries[part].astype(np.float64) if self.exact else self.entries[part]


def _whole(values: np.ndarray, exact: bool) -> np.ndarray:
    """Floats that hold whole numbers, as they are or as Python's whole numbers."""
    if exact:
        return values
    return np.array([int(v) for v in values.reshape(-1)], dtype=object).reshape(values.shape)


def _scaled(lists: list[list[float]], width: int) -> np.ndarray:
    """floor(SCALE * x) of each component, vectors padded with zeros to ``width``."""
    out = np.zeros((len(lists), width))
    for row, values in zip(out, lists):
        row[: len(values)] = values
    return np.floor(SCALE * out)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows whose vector has finite components only."""
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select("vec_id", F.col("label").cast("long").alias("label"), x.alias("embedding")).where(F.col("embedding").isNotNull() & ~odd)


def grow(kept: DataFrame, width: int, parts: int) -> DataFrame:
    """Blocks of scaled vectors with their trees, from each task's own rows."""

    def block(rows: list) -> pa.RecordBatch:
        ids, labels, lists = zip(*rows)
        vectors = _scaled(lists, width)
        trees = [Tree.grow(p).to_bytes() for p in np.split(vectors, parts, axis=1)]
        columns = [pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(labels)], pa.list_(pa.int64())), pa.array([vectors.astype("<f8").tobytes()]), pa.array([trees])]
        return pa.RecordBatch.from_arrays(columns, ["vec_ids", "labels", "vectors", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        for batch in batches:
            rows += zip(*[c.to_pylist() for c in batch.columns])
            while len(rows) >= BLOCK:
                yield block(rows[:BLOCK])
                rows = rows[BLOCK:]
        if rows:
            yield block(rows)

    return kept.mapInArrow(run, BLOCKS)


def _read(batch: pa.RecordBatch, width: int, parts: int, exact: bool) -> Iterator[tuple[pa.RecordBatch, list[Tree], list[np.ndarray]]]:
    """Each block with its trees and its parts in tree order."""
    for i in range(batch.num_rows):
        row = batch.slice(i, 1)
        vectors = np.frombuffer(row.column("vectors")[0].as_buffer(), "<f8").reshape(-1, width)
        trees = [Tree.from_bytes(b) for b in row.column("trees")[0].as_py()]
        yield row, trees, [_whole(p[t.order], exact) for p, t in zip(np.split(vectors, parts, axis=1), trees)]


def lloyd_sums(blocks: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """(part, entry, position, limb, total) summed over all blocks; position -1 counts the vectors.

    Sums beyond 32 bits travel as limbs, ``total * 2**(32 * limb)``, so that no sum of sums overflows.
    """
    parts = len(books.entries)

    def limbs(part: int, entry: int, position: int, total: int) -> Iterator[tuple[int, int, int, int, int]]:
        limb = 0
        while -(1 << 40) >= total or total >= 1 << 40:
            yield part, entry, position, limb, total & 0xFFFFFFFF
            total, limb = total >> 32, limb + 1
        if total:
            yield part, entry, position, limb, total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(e.shape, object) for e in books.entries]
        counts = [np.zeros(len(e), np.int64) for e in books.entries]
        for batch in batches:
            for _, trees, points in _read(batch, width, parts, books.exact):
                for part, (tree, p) in enumerate(zip(trees, points)):
                    begin, end, entry, at, chosen = assign(tree, p, books.numbers(part))
                    running = np.concatenate([np.zeros((1, p.shape[1]), p.dtype), np.cumsum(p, axis=0)])
                    add = np.zeros(sums[part].shape, p.dtype)
                    np.add.at(add, entry, running[end] - running[begin])
                    np.add.at(add, chosen, p[at])
                    sums[part] += _whole(add, False) if books.exact else add
                    np.add.at(counts[part], entry, end - begin)
                    np.add.at(counts[part], chosen, 1)
        rows = []
        for part in range(parts):
            for entry in np.flatnonzero(counts[part]).tolist():
                rows += limbs(part, entry, -1, int(counts[part][entry]))
                for position, total in enumerate(sums[part][entry].tolist()):
                    rows += limbs(part, entry, position, int(total))
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "position", "limb", "total"])

    made = blocks.mapInArrow(run, "part long, entry long, position long, limb long, total long")
    return made.groupBy("part", "entry", "position", "limb").agg(F.sum("total").alias("total"))


def _moved(books: Codebooks, sums: DataFrame) -> Codebooks:
    """Entries replaced by the floor of their vectors' mean; unused ones stay."""
    totals: dict[tuple[int, int], dict[int, int]] = {}
    for r in sums.collect():
        place = totals.setdefault((r.part, r.entry), {})
        place[r.position] = place.get(r.position, 0) + (r.total << 32 * r.limb)
    entries = [e.copy() for e in books.entries]
    for (part, entry), total in totals.items():
        n = total.pop(-1)
        entries[part][entry] = [total.get(i, 0) // n for i in range(entries[part].shape[1])]
    return Codebooks(entries, books.exact)


def codes_of(blocks: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """(vec_id, label, code, error): a byte per part, and the summed exact squared distances; one beyond a long is the largest long."""
    parts = len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, trees, points in _read(batch, width, parts, books.exact):
                n = len(trees[0].order)
                codes, errors = np.zeros((n, parts), np.uint8), np.zeros(n, object)
                for part, (tree, p) in enumerate(zip(trees, points)):
                    entries = books.numbers(part)
                    begin, end, entry, at, chosen = assign(tree, p, entries)
                    own = np.zeros(n, np.int64)
                    own[np.repeat(begin - np.append(0, np.cumsum(end - begin)[:-1]), end - begin) + np.arange((end - begin).sum())] = np.repeat(entry, end - begin)
                    own[at] = chosen
                    codes[tree.order, part] = own
                    errors[tree.order] += _whole(((p - entries[own]) ** 2).sum(axis=1), False)
                out = [row.column("vec_ids")[0].values, row.column("labels")[0].values, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([min(e, MOST) for e in errors], pa.int64())]
                yield pa.RecordBatch.from_arrays(out, ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, "vec_id long, label long, code binary, error long")


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """((vec_id, label, code, error), codebooks) of ``vectors(vec_id, embedding, label)``.

    Rows without a vector, or with a null or non-finite component, are dropped.  Components become ``floor(SCALE * x)``.
    Vectors whose length is no multiple of ``parts``, or below the longest one, count as padded with zeros.  Codebooks begin as
    the parts of the vectors of the smallest vec_ids - null ids last, equal ids by their vectors - and have fewer entries
    if there are fewer vectors.  Repeated rows count each for itself; an empty table has empty codebooks and no codes;
    other columns are ignored.
    """
    if entries > 256:
        raise ValueError("a code is one byte")
    kept = usable(vectors)
    size = F.max(F.size("embedding")).alias("size")
    most = F.max(F.array_max(F.transform("embedding", F.abs))).alias("most")
    shape = kept.agg(size, most, F.count("*").alias("n")).first()
    if not shape.n:
        return kept.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), Codebooks([], True)
    step = max(1, -(-shape.size // parts))
    width, largest = step * parts, int(np.floor(SCALE * (shape.most or 0.0))) + 1
    exact = step * (2 * largest) ** 2 < 1 << 53 and BLOCK * largest < 1 << 53
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    start = _whole(_scaled([r.embedding for r in first], width), False)
    books = Codebooks(np.split(start, parts, axis=1), exact)
    blocks = written(grow(kept, width, parts), "cover-trees")
    for _ in range(rounds):
        books = _moved(books, lloyd_sums(blocks, books, width))
    return codes_of(blocks, books, width), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the errors summed over equal labels, null ones together; at most the largest long.

    Errors are added up inside each task first, and a label's sum comes back by a join that broadcasts few labels.
    """
    codes = written(codes, "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    sums = written(codes.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error")), "label-errors")
    return codes.join(small_side(sums), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
