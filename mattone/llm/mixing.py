"""Text probabilities by logistic mixing of hashed-context bit predictors.

A text is its bytes and an end byte, each coded as eight binary decisions, high bit first.  ORDERS predictors each know the
decision's context: some bytes before, or the word so far, and the bits already known.  Contexts are hashed to
slots of 15 decisions per half byte; a slot keeps the log odds of its counts over the training texts,
0 if it was never met.  The log odds are added up by weights chosen by a gate, the place of the bit in its byte, and the
sum is the log odds of the bit.  Weights start from START and are refined online through the whole text, after each block
of bytes by the gradient of the coding cost.  Blocks are BLOCK bytes long at first and grow with the place in the text
(``blocks``), so a long text takes few rounds; they depend on that place alone, and texts are scored side by side.

Counts of all training texts are gathered: each task sends its counts, which are summed by chunk of a table in two steps.
The number of slots is fixed for each context, whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.llm.arrays import Words, _power, flat, mix, slices
from mattone.llm.scratch import written

# Bytes before, or the word so far, and the binary logarithm of the number of slots.
CONTEXTS = ((1, 18), (2, 18), (3, 20), (5, 20), ("word", 20))
ORDERS = len(CONTEXTS)
CHUNK = 1 << 18
PRIOR = 0.3
STEP = 1 / 14
START = (0.10, 0.15, 0.25, 0.40, 0.35)
RATE = 0.01
# The gradient of a longer block counts less, by this power of its length.
DAMPED = 0.75
# Bits are never surer than this log odds.
SUREST = 10.0
# Blocks hold BLOCK bytes, then a sixteenth of the bytes before them, LONGEST at most.
BLOCK, LONGEST = 16, 1 << 14
END = 0xFF
PAD = 5
# Token counts are broadcast for at most so many tokens, the most frequent ones; the others are joined.
FREQUENT = 1 << 18
SALTS = 16

_CODEC = pa.Codec("zstd", 1)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_C12 = np.uint64(0x9E3779B97F4A7C15 * 0xC2B2AE3D27D4EB4F % (1 << 64))
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.arange(256)
_BITS = (_BYTE[:, None] >> np.arange(7, -1, -1) & 1).astype(np.float32)
# The last row is for places behind the end of a text.
_SIGN = np.concatenate([2 * _BITS - 1, np.zeros((1, 8), np.float32)])
_BEHIND = len(_BITS)
_half = lambda h: np.stack([np.ones_like(h), 2 + (h >> 3), 4 + (h >> 2), 8 + (h >> 1)], axis=1)
_NODES = np.concatenate([_half(_BYTE >> 4), _half(_BYTE & 15)], axis=1).astype(np.int32)
# The same in two slots of 16 cells, one after the other.
_CELLS = _NODES.astype(np.int64) + np.repeat([0, 16], 4)


def stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, end): each text after PAD zeros and before its end byte; text i with its end is ``begin[i]:end[i]``."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    out = np.zeros(len(data) + n * (PAD + 1), np.uint8)
    begin = offsets[:-1] + (PAD + 1) * np.arange(n) + PAD
    out[np.arange(len(data)) + np.repeat(begin - offsets[:-1], np.diff(offsets))] = data
    end = begin + np.diff(offsets)
    out[end] = END
    return out, begin, end + 1


def _rows(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each context, the slots of the high and the low half of every byte."""
    n = len(data)
    wide = np.zeros(PAD + n, np.uint64)
    wide[PAD:] = data
    past = wide[PAD - 1 : PAD - 1 + n].copy()
    for j in range(2, PAD + 1):
        past |= wide[PAD - j : PAD - j + n] << np.uint64(8 * (j - 1))
    wide = wide[PAD:]
    # (c + h * C1) * C2 is c * C2 + h * (C1 * C2), so one product serves both halves.
    turn = ((wide >> np.uint64(4)) + np.uint64(1)) * _C12
    for number, (context, size) in enumerate(CONTEXTS):
        shift = np.uint64(64 - size)
        if context == "word":
            before = np.zeros(n, np.uint8)
            before[1:] = data[:-1]
            fresh = (before == 0x20) | (before == 0x0A) | (before == 0)
            start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
            prefix = np.zeros(n + 1, np.uint64)
            wide += np.uint64(1)
            wide *= _power(_BASE, n)[:n]
            np.cumsum(wide, out=prefix[1:])
            code = prefix[:n] - prefix.take(start)
            code *= _power(_INVERSE, n).take(start)
        else:
            code = past & np.uint64((1 << 8 * context) - 1)
        code += np.uint64(number + 1)
        code *= _C1
        code ^= code >> np.uint64(32)
        code *= _C2
        first = (code >> shift).astype(np.int32)
        code += turn
        code >>= shift
        yield first, code.astype(np.int32)


def slots(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As ``_rows``, each slot by the first of its 16 cells."""
    for pair in _rows(data):
        yield tuple(at << 4 for at in pair)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(context, chunk, salt, cells, counts) of a task's texts; only chunks and cells that it met."""
    total = [np.zeros(16 << bits, np.uint32) for _, bits in CONTEXTS]
    one = np.uint32(1)
    for piece in slices(batches, most=1 << 17):
        data, begin, _ = stream(piece.column("text"))
        halves = (data >> 4).astype(np.int64), (data & 15).astype(np.int64)
        # The zeros before each text are counted with the others and taken off again.
        pads = (begin[:, None] + np.arange(-PAD, 0)).reshape(-1)
        for k, pair in enumerate(_rows(data)):
            for at, half in zip(pair, halves):
                cell = at.astype(np.int64)
                cell <<= 4
                cell += half
                np.add.at(total[k], cell, one)
                np.subtract.at(total[k], cell[pads], one)
    salt = TaskContext.get().partitionId() % SALTS
    for k in range(ORDERS):
        for chunk in range(len(total[k]) // CHUNK):
            part = total[k][chunk * CHUNK : (chunk + 1) * CHUNK].astype(np.int64)
            if part.any():
                yield _packed(k, chunk, salt, part)


def _squeeze(counts: np.ndarray) -> bytes:
    return _CODEC.compress(counts.tobytes(), asbytes=True)


def _spread(packed: bytes) -> np.ndarray:
    return np.frombuffer(_CODEC.decompress(packed, 8 * CHUNK, asbytes=True), np.int64)


_PACKED = "context int, chunk int, salt int, counts binary"


def _packed(context: int, chunk: int, salt: int, counts: np.ndarray) -> pa.RecordBatch:
    row = [pa.array([context], pa.int32()), pa.array([chunk], pa.int32()), pa.array([salt], pa.int32()), pa.array([_squeeze(counts)], pa.binary())]
    return pa.RecordBatch.from_arrays(row, ["context", "chunk", "salt", "counts"])


def _sum_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by (context, chunk, salt) of the rows of a task, held as one array of CHUNK numbers for each."""
    total: dict[tuple[int, int, int], np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            key = row["context"], row["chunk"], row["salt"]
            counts = _spread(row["counts"])
            if key in total:
                total[key] += counts
            else:
                total[key] = counts.copy()
    for key, counts in total.items():
        yield _packed(*key, counts)


def log_odds(counts: np.ndarray) -> np.ndarray:
    """From counts of half bytes, 16 per slot, the quantised log odds of each of the 15 decisions of a slot."""
    leaf = counts.reshape(-1, 16).astype(np.float64)
    out = np.zeros((len(leaf), 16))
    for depth in range(4):
        side = leaf.reshape(len(leaf), 1 << depth, 2, -1).sum(axis=3)
        out[:, 1 << depth : 2 << depth] = np.log((side[:, :, 1] + PRIOR) / (side[:, :, 0] + PRIOR))
    return np.clip(np.rint(out / STEP), -127, 127).astype(np.int8).reshape(-1)


def blocks(length: int) -> Iterator[tuple[int, int]]:
    """(begin, size) of the blocks after each of which the weights of a text move; the last may reach beyond its end."""
    at = 0
    while at < length:
        size = min(max(at // (16 * BLOCK) * BLOCK, BLOCK), LONGEST)
        yield at, size
        at += size


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sum_chunks(batches):
        row = batch.to_pylist()[0]
        odds = log_odds(_spread(row["counts"]))
        yield pa.RecordBatch.from_arrays([pa.array([row["context"]], pa.int32()), pa.array([row["chunk"]], pa.int32()), pa.array([odds.tobytes()], pa.binary())], ["context", "chunk", "odds"])


@dataclass
class Mixer:
    """Tables of log odds, one per context; their size is fixed."""

    tables: list[np.ndarray]

    def cost(self, texts: pa.Array) -> np.ndarray:
        """The bits that each text and its end cost: minus the log2 of their probability."""
        data, begin, end = stream(texts)
        places = [np.stack(pair, axis=1).view(np.int64)[:, 0] for pair in _rows(data)]
        tables = [table.view(np.complex128) for table in self.tables]
        order = np.argsort(begin - end, kind="stable")
        first, last = begin[order], end[order]
        length = last - first
        bits = np.zeros(len(order))
        # Weights of quantised log odds, so that the odds need no scaling; of a text's eight bits, text by text.
        weights = np.tile(np.repeat(np.array(START, np.float32)[:, None] * np.float32(STEP), 8, axis=1), len(order))
        lead = np.zeros(0, np.int64)
        for at, size in blocks(int(length[0]) if len(length) else 0):
            rate = np.float32(RATE * STEP * STEP * (BLOCK / size) ** DAMPED)
            live = int(np.searchsorted(-length, -at, side="left"))
            n, wide = live * size, live * 8
            # A row for each place of the block, in it the texts side by side: what is done with weights runs along rows.
            where = np.arange(at, at + size)[:, None] + first[:live]
            there = where < last[:live]
            np.minimum(where, len(data) - 1, out=where)
            byte = data.take(where)
            sign = _SIGN.take(np.where(there, byte, _BEHIND), axis=0).reshape(size, wide)
            # A slot is taken as a whole, 16 bytes at once; the decisions' places in what is taken are those of all contexts.
            if len(lead) < 8 * n:
                lead = np.repeat(np.arange(0, 32 * n, 32), 8)
            cell = _CELLS.take(byte, axis=0).reshape(-1)
            cell += lead[: 8 * n]
            odds = np.empty((ORDERS, size, wide), np.float32)
            for k, pair in enumerate(places):
                taken = tables[k].take(pair.take(where).view(np.int32))
                odds[k] = taken.view(np.int8).reshape(-1).take(cell).reshape(size, wide)
            w = weights[:, :wide]
            z = odds[0] * w[0]
            term = np.empty_like(z)
            for k in range(1, ORDERS):
                z += np.multiply(odds[k], w[k], out=term)
            z *= sign
            np.clip(z, -SUREST, SUREST, out=z)
            np.negative(z, out=z)
            e = np.exp(z, out=z)
            inverse = np.add(e, 1, out=term)
            # The eight bits' inverse probabilities, multiplied, and one logarithm per byte.
            pairs = (inverse[:, 0::2] * inverse[:, 1::2]).reshape(size, live, 4)
            costs = np.log(pairs[..., 0] * pairs[..., 1] * pairs[..., 2] * pairs[..., 3])
            costs *= there
            bits[:live] += np.ascontiguousarray(costs.T).sum(axis=1, dtype=np.float64)
            e /= inverse
            e *= sign
            for k in range(ORDERS):
                w[k] += rate * np.einsum("tx,tx->x", e, odds[k])
        out = np.empty(len(order))
        out[order] = bits / np.log(2)
        return out


def fit_mixer(documents: DataFrame) -> Mixer:
    """Count the contexts of the whole texts of all rows; null texts are empty ones."""
    parts = documents.select("text").mapInArrow(_tally, _PACKED)
    parts = parts.repartition("context", "chunk", "salt").mapInArrow(_sum_chunks, _PACKED).withColumn("salt", F.lit(0))
    summed = parts.repartition("context", "chunk").mapInArrow(_finish, "context int, chunk int, odds binary")
    tables = [np.zeros(16 << bits, np.int8) for _, bits in CONTEXTS]
    for row in summed.toLocalIterator():
        tables[row["context"]][row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["odds"], np.int8)
    return Mixer(tables)


END_TOKEN = int(mix(np.array([0x454E44], np.uint64)).view(np.int64)[0])


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): 64-bit hashes of the lower-cased words of each text, its end not among them."""
    words = Words.of(texts, lower=True)
    return words.hashes().view(np.int64), words.first


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n) of a task's texts, words and ends."""
    known, seen, docs = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for piece in slices(batches):
        hashes, _ = token_hashes(piece.column("text"))
        docs += piece.num_rows
        u, c = np.unique(hashes, return_counts=True)
        known, where = np.unique(np.concatenate([known, u]), return_inverse=True)
        seen = np.bincount(where, weights=np.concatenate([seen, c]), minlength=len(known)).astype(np.int64)
    if docs:
        known, seen = np.append(known, END_TOKEN), np.append(seen, docs)
    for i in range(0, len(known), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(known[i : i + (1 << 16)]), pa.array(seen[i : i + (1 << 16)])], ["token", "n"])


def count_tokens(documents: DataFrame) -> DataFrame:
    """(token, c): how often each word, by its 64-bit hash, and the end occurs in the texts of all rows."""
    counts = documents.select("text").mapInArrow(_count_tokens, "token long, n long").groupBy("token").agg(F.sum("n").alias("c"))
    return written(counts, "token-counts")


def frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens in order and their counts, of all that occur more often than a bound, at most FREQUENT; and that bound."""
    steps = counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).toLocalIterator()
    total, bound = 0, 0
    for row in steps:
        total += row["n"]
        if total > FREQUENT:
            bound = row["c"]
            break
    rows = counts.where(F.col("c") > bound).toArrow()
    tokens, c = rows["token"].to_numpy(), rows["c"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], c[order], bound


_SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, bits double, n_bytes long, rare array<long>, times array<long>"


def text_scores(documents: DataFrame, training: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row's whole text.

    Learnt from the rows of ``training``.  score is the log10 probability of the text and its end by the mixed
    predictors, base_score the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over its tokens, the words in lower case and
    an end: c counts the token, N all tokens and V the distinct ones of the training texts; n_known tokens have c > 0.

    A null text is empty: an end alone.  A null doc_id is scored like any other and repeated rows are scored each.
    Without training rows no context is known and N = V = 0.  An empty table gives an empty result; other columns are ignored.
    """
    docs = documents.select("doc_id", "text")
    learnt = docs.where(training)
    counts = count_tokens(learnt)
    n_all, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    whole = n_all + 0.5 * (distinct + 1)
    tokens, often, bound = frequent(counts)
    context = documents.sparkSession.sparkContext
    known = context.broadcast((tokens, often))
    tables = context.broadcast(fit_mixer(learnt).tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, c = known.value
        mixer = Mixer(tables.value)
        row = TaskContext.get().partitionId() << 40
        log_c = np.log10((c + 0.5) / whole)
        for piece in slices(batches, most=1 << 18):
            texts = piece.column("text")
            bits = mixer.cost(texts)
            hashes, first = token_hashes(texts)
            n = np.diff(first)
            at = np.minimum(np.searchsorted(own, hashes), max(len(own) - 1, 0))
            hit = own[at] == hashes if len(own) else np.zeros(len(hashes), bool)
            doc = np.repeat(np.arange(len(n)), n)
            base = np.bincount(doc[hit], weights=log_c[at[hit]], minlength=len(n))
            met = np.bincount(doc[hit], minlength=len(n))
            end_at = np.searchsorted(own, END_TOKEN)
            ends = bool(end_at < len(own) and own[end_at] == END_TOKEN)
            rare, times = [], []
            miss = np.flatnonzero(~hit)
            cuts = np.searchsorted(miss, first)
            for i in range(len(n)):
                u, k = np.unique(hashes[miss[cuts[i] : cuts[i + 1]]], return_counts=True)
                rare.append(u if ends else np.append(u, END_TOKEN))
                times.append(k if ends else np.append(k, 1))
            if ends:
                base, met = base + log_c[end_at], met + 1
            lists = [pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in own_])]).astype(np.int32), pa.array(np.concatenate(own_).astype(np.int64))) for own_ in (rare, times)]
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            numbers = [pa.array(row + np.arange(len(n))), piece.column("doc_id"), pa.array(n + 1), pa.array(met.astype(np.int64)), pa.array(base), pa.array(bits), size]
            yield pa.RecordBatch.from_arrays([*numbers, *lists], ["row", "doc_id", "n_tokens", "n_known", "base", "bits", "n_bytes", "rare", "times"])
            row += len(n)

    scored = written(docs.mapInArrow(run, _SCORED), "scored")
    rest = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.times").alias("times"))
    joined = rest.join(counts.where(F.col("c") <= bound), "token", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    log = F.log10((F.col("c") + 0.5) / F.lit(whole))
    rest = joined.groupBy("row").agg(F.sum(F.col("times") * log).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("met"))
    out = scored.drop("rare", "times").join(rest, "row", "left")
    return out.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (-F.col("bits") * F.lit(float(np.log10(2)))).alias("score"),
        (F.col("bits") / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
