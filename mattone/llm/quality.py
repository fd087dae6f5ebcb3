"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

The features cos(w x + b) approximate a Gaussian kernel over standardised statistics of the text alone.
Each partition sums its part of the normal equations; their sum, of a size set by FEATURES, is solved
on the driver.  Raw scores of a fold the equations do not see are calibrated by pooling adjacent violators.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.llm.arrays import NEWLINE, Words, slices
from mattone.llm.scratch import fold, written

FEATURES = 256
BANDWIDTH = 2.0
RIDGE = 1e-3
BINS = 1000
THRESHOLD = 0.7
SEED = 4


def _class(chars: str) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(chars.encode())] = True
    return flags


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_LETTER[0xC3:0xF5] = True
_BYTE_CLASSES = [_UPPER, _class("0123456789"), _class("#*$%&|<>"), _class("!"), _class("|"), _class(".,;:?")]
STATISTICS = [
    "log_words", "word_bytes", "upper", "digits", "symbols", "exclaims", "pipes", "stops", "letters",
    "distinct_words", "distinct_pairs", "echoes", "words_per_line", "distinct_lines", "short_words",
]


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of STATISTICS per text; a null, empty or wordless text has zeros where there is nothing to count."""
    words = Words.of(texts, lower=False)
    lines = Words.of(texts, lower=False, apart=NEWLINE)
    size = np.diff(words.offsets)
    n = np.diff(words.first)
    some, chars = np.maximum(n, 1), np.maximum(size, 1)

    def count(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[at])

    hashes, length = words.hashes(), words.end - words.start
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:] if len(hashes) > 1 else hashes[:0]
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    line_hash = lines.hashes()
    distinct = np.zeros((3, len(n)))
    for i, (lo, hi, a, b) in enumerate(zip(words.first[:-1], words.first[1:], lines.first[:-1], lines.first[1:])):
        distinct[:, i] = len(np.unique(hashes[lo:hi])), len(np.unique(pairs[lo : max(lo, hi - 1)])), len(np.unique(line_hash[a:b]))
    n_lines = np.maximum(np.diff(lines.first), 1)
    letters = count(_LETTER[words.data], words.offsets)
    by_class = [count(c[words.data], words.offsets) for c in _BYTE_CLASSES]
    columns = [
        np.log1p(n),
        count_bytes(words, n) / some,
        by_class[0] / np.maximum(letters, 1),
        *[c / chars for c in by_class[1:]],
        letters / chars,
        distinct[0] / some,
        distinct[1] / np.maximum(n - 1, 1),
        count(same, words.first) / some,
        np.log1p(n / n_lines),
        distinct[2] / n_lines,
        count(length <= 3, words.first) / some,
    ]
    return np.column_stack(columns) if len(n) else np.zeros((0, len(STATISTICS)))


def count_bytes(words: Words, n: np.ndarray) -> np.ndarray:
    total = np.zeros(len(words.start) + 1, np.int64)
    np.cumsum(words.end - words.start, out=total[1:])
    return total[words.first[1:]] - total[words.first[:-1]]


def measure(documents: DataFrame) -> DataFrame:
    """(doc_id, x: array<double>) of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), _lists(statistics(piece.column("text")))], ["doc_id", "x"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.reshape(-1)))


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Quality:
    """A fitted model; a few hundred numbers, whatever the number of documents."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.normal(size=(x.shape[1], FEATURES)) / (BANDWIDTH * np.sqrt(x.shape[1]))
        b = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1: the calibrated share of label 1."""
        return np.interp(self.raw(x), self.at, self.value)


def pool_adjacent(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing values nearest to ``y`` by weighted squares."""
    blocks: list[list[float]] = []
    for value, w in zip(y, weight):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(k), v) for v, _, k in blocks]) if blocks else np.zeros(0)


def fit_quality(measured: DataFrame, labels: DataFrame, held_out: Column | None = None) -> Quality | None:
    """Fit on all labelled rows of ``measured(doc_id, x)`` outside ``held_out``, or None without any.

    Rows with a null id or label are not learnt from; several labels of a document count each.
    Of four folds by doc_id, fold 3 calibrates and the others are fitted (all rows do both if either is empty).
    """
    rows = measured.join(labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("y is not null"), "doc_id")
    if held_out is not None:
        rows = rows.where(~held_out)
    rows = written(rows.select("x", "y", (fold(F.col("doc_id"), 4) == 3).alias("late")), "labelled")
    width = range(len(STATISTICS))
    moments = rows.agg(F.count("*"), F.count_if("late"), *[f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in width]).first()
    total, late = moments[0], moments[1]
    if not total:
        return None
    mean, spread = (np.array(moments[2 + k * len(width) : 2 + (k + 1) * len(width)], float) for k in (0, 1))
    model = Quality(mean, np.where(spread > 1e-9, spread, 1.0), np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    split = 0 < late < total
    side = FEATURES + 2
    upper = np.triu_indices(side)

    def normal_equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((side, side))
        for batch in batches:
            if batch.num_rows:
                z = np.column_stack([model.features(_rows(batch.column("x"))), batch.column("y").to_numpy()])
                gram += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(gram[upper])], ["cell", "part"])

    cells = (rows.where("not late") if split else rows).mapInArrow(normal_equations, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("part"))
    sums = cells.toPandas().sort_values("cell")["part"].to_numpy()
    gram = np.zeros((side, side))
    gram[upper] = sums
    gram = gram + np.triu(gram, 1).T
    n = gram[side - 2, side - 2]
    penalty = RIDGE * n * np.eye(side - 1) / FEATURES
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(gram[:-1, :-1] + penalty, gram[:-1, -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = np.clip(model.raw(_rows(batch.column("x"))), -1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.floor(raw * BINS).astype(np.int32)), batch.column("y")], ["bin", "y"])

    bins = (rows.where("late") if split else rows).mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).toPandas().sort_values("bin")
    model.at = (bins["bin"].to_numpy() + 0.5) / BINS
    model.value = np.clip(pool_adjacent(bins["y"].to_numpy(), bins["n"].to_numpy()), 0, 1)
    return model


def score_measured(measured: DataFrame, model: Quality | None) -> DataFrame:
    """(doc_id, score) per row; without a model every score is 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = np.full(batch.num_rows, 0.5) if model is None else model.score(_rows(batch.column("x")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return measured.mapInArrow(run, "doc_id long, score double")


def accepted(documents: DataFrame, model: Quality | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` whose score reaches ``threshold``, read once more and not shuffled.

    Without a model there is nothing to reject by, and all rows stay.
    """
    if model is None:
        return documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield piece.filter(pa.array(model.score(statistics(piece.column("text"))) >= threshold))

    return documents.mapInArrow(run, documents.schema)


def quality_scores(documents: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, score) of every row, by a model that has not seen the labels of ``held_out`` rows.

    Null, empty and wordless texts are scored by their (zero) statistics; a null doc_id is scored and
    never learnt from; repeated rows are scored each; an empty table gives an empty result.
    """
    measured = written(measure(documents), "statistics")
    return score_measured(measured, fit_quality(measured, labels, held_out))
