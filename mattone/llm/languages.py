"""Languages of a text as a mixture: expectation-maximisation over n-gram likelihoods, the set by penalised likelihood.

Each language is a distribution over hashed byte trigrams (A-Z lower-cased, other ASCII than letters as blanks),
counted over all training texts.  A document's trigrams are drawn from a mixture of languages; EM gives the
proportions.  Starting with all languages, the least one is left out as long as the log-likelihood falls by less than
PENALTY * log(trigrams) / 2, the price of a proportion.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mattone.llm.arrays import flat, slices

BINS = 1 << 16
SMOOTHING = 0.5
STEPS = 12
PENALTY = 4.0
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 0x20
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bins, offsets): the trigram bins of each text between two blanks, as 16-bit numbers."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    padded = np.full(len(data) + 2 * n + 2, 0x20, dtype=np.uint32)
    padded[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, sizes)] = _FOLD[data]
    bins = (padded[:-2] * np.uint32(0x9E3779B1) ^ padded[1:-1] * np.uint32(0x85EBCA6B) ^ padded[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    # A text of s bytes, padded to s + 2, has s trigrams; the two that reach into the next text are skipped.
    inside = np.ones(len(padded) - 2, dtype=bool)
    ends = offsets[1:] + 2 * np.arange(1, n + 1)
    inside[ends - 1] = inside[ends - 2] = False
    return (bins[inside[: len(bins)]] >> np.uint32(16)).astype(np.uint16), offsets


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for piece in slices(batches):
        bins, offsets = trigrams(piece.column("text"))
        by_lang: dict[str, list[np.ndarray]] = {}
        for i, lang in enumerate(piece.column("lang").to_pylist()):
            by_lang.setdefault(lang, []).append(bins[offsets[i] : offsets[i + 1]])
        for lang, parts in by_lang.items():
            total[lang] = total.get(lang, 0) + np.bincount(np.concatenate(parts), minlength=BINS)
    for lang, counts in total.items():
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["lang", "bin", "n"])


@dataclass
class Languages:
    """Names in order, and for every bin the probability of it in each language."""

    names: list[str]
    p: np.ndarray

    def mixtures(self, texts: pa.Array) -> np.ndarray:
        """Language proportions of each text; languages outside the chosen set have 0."""
        bins, offsets = trigrams(texts)
        n, k = len(texts), len(self.names)
        distinct, weight, size = [], [], np.zeros(n, np.int64)
        for i in range(n):
            u, c = np.unique(bins[offsets[i] : offsets[i + 1]], return_counts=True)
            distinct.append(u)
            weight.append(c)
            size[i] = len(u)
        entry = np.concatenate(distinct) if n else np.zeros(0, np.uint16)
        weight = np.concatenate(weight).astype(np.float64) if n else np.zeros(0)
        begin = np.concatenate([[0], np.cumsum(size)])
        total = np.diff(offsets).astype(np.float64)
        live = np.flatnonzero(size > 0)
        best = np.zeros((n, k))
        if not len(live):
            return best

        def em(rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Proportions and log-likelihoods of some texts, each within its own set of languages."""
            at = np.concatenate([np.arange(begin[r], begin[r + 1]) for r in rows])
            first = np.concatenate([[0], np.cumsum(size[rows])])[:-1]
            p, w = self.p[entry[at]], weight[at][:, None]
            share = allowed / allowed.sum(axis=1, keepdims=True)
            for _ in range(STEPS):
                part = p * np.repeat(share, size[rows], axis=0)
                part *= w / part.sum(axis=1, keepdims=True)
                share = np.add.reduceat(part, first, axis=0) / total[rows][:, None]
            mixed = (p * np.repeat(share, size[rows], axis=0)).sum(axis=1)
            return share, np.add.reduceat(np.log(mixed) * w[:, 0], first)

        rows, allowed = live, np.ones((len(live), k))
        share, fit = em(rows, allowed)
        best[rows] = share
        price = PENALTY * np.log(np.maximum(total, 2)) / 2
        for _ in range(k - 1):
            least = np.where(allowed > 0, share, 2.0).argmin(axis=1)
            smaller = allowed.copy()
            smaller[np.arange(len(rows)), least] = 0
            share, fewer = em(rows, smaller)
            better = fewer + price[rows] >= fit
            rows, allowed, share, fit = rows[better], smaller[better], share[better], fewer[better]
            best[rows] = share
            if not len(rows):
                break
        return best


def fit_languages(documents: DataFrame) -> Languages:
    """Trigram distributions of the non-null ``lang`` values of all rows; their number times BINS bounds the model."""
    rows = documents.where("lang is not null").select("lang", "text").mapInArrow(_count, "lang string, bin int, n long")
    counts = rows.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(counts["lang"].unique())
    p = np.zeros((BINS, len(names)))
    p[counts["bin"].to_numpy(), [names.index(x) for x in counts["lang"]]] = counts["n"].to_numpy()
    p += SMOOTHING
    return Languages(names, p / p.sum(axis=0))


def language_mixtures(documents: DataFrame, languages: Languages) -> DataFrame:
    """(doc_id, languages: map of the chosen set to proportions, lang_pred, score) of every row's whole text.

    lang_pred is the language of the largest proportion, of equal ones the first by name, and score that
    proportion.  A null text or one without a letter, or any text where nothing was learnt, is ``und`` with score 0 and an
    empty map.  A null doc_id is kept; repeated rows are answered each; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 19):
            texts = piece.column("text")
            share = languages.mixtures(texts) if languages.names else np.zeros((len(texts), 1))
            known = np.array([any(map(str.isalpha, t or "")) for t in texts.to_pylist()], bool) & (share.max(axis=1) > 0)
            top = share.argmax(axis=1)
            names = [languages.names[t] if k else UNKNOWN for t, k in zip(top, known)]
            maps = [[(languages.names[j], float(row[j])) for j in np.flatnonzero(row)] if k else [] for row, k in zip(share, known)]
            score = np.where(known, np.minimum(share[np.arange(len(top)), top], 1.0), 0.0)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(maps, pa.map_(pa.string(), pa.float64())), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "languages", "lang_pred", "score"]
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, languages map<string, double>, lang_pred string, score double")
