"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A document's set is its distinct five-word shingles (lower-cased A-Z).  A signature
holds 65 MinHash values of 16 bits.  Two sets of Jaccard similarity 0.85 differ
in 9.75 of 65 values on average (standard deviation 2.9); signatures within
RADIUS = 25, more than five deviations above, are searched for **without loss**:
25 differences over 13 chunks of 5 values leave some chunk with at most one, so
both signatures share one of that chunk's five keys, each with one value left out.

Steps: equal sets are one class, named by its smallest id.  Classes that share a key
form a bucket.  In the first rounds each class is compared to one hub of its buckets, which
merges large groups at linear cost.  What is left are pairs of a bucket in different components.  Thousands of
texts may share a passage and yet no link, so these pairs are not listed: of two linked sets the smaller one's
rarest few shingles and the larger one's meet (prefix filter, without loss), and such pairs only
are compared.  No link that joins two components is missed.  A link is confirmed on the full sets of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mattone.llm.arrays import Words, mix, slices
from mattone.llm.links import components
from mattone.llm.scratch import small_side, written

WIDTH = 5
CHUNKS, CHUNK, ERRORS = 13, 5, 1
VALUES = CHUNKS * CHUNK
RADIUS = CHUNKS * (ERRORS + 1) - 1
HUB_ROUNDS = 2
# Counters that order shingles by how common they are; shared counters change the order, not the result.
SLOTS = 1 << 16

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)
_SALT = np.uint64(0xA24BAED4963EE407)


def signature(items: np.ndarray) -> np.ndarray:
    """The 16-bit MinHash values of one non-empty set of 64-bit hashes."""
    low = (items >> np.uint64(32)).astype(np.uint32)
    best = np.full(VALUES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(low), 4096):
        np.minimum(best, (_FACTORS[:, None] * low[None, i : i + 4096] + _SHIFTS[:, None]).min(axis=1), out=best)
    return (best & np.uint32(0xFFFF)).astype(np.uint16)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        hashes, begin, end = Words.of(piece.column("text"), lower=True).shingles(WIDTH)
        n, d1, d2, sig = [], [], [], []
        for lo, hi in zip(begin.tolist(), end.tolist()):
            items = np.unique(hashes[lo:hi])
            n.append(len(items))
            d1.append(int(mix(items).sum().view(np.int64)) if len(items) else 0)
            d2.append(int(mix(items ^ _SALT).sum().view(np.int64)) if len(items) else 0)
            sig.append(signature(items).tobytes() if len(items) else None)
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "n", "d1", "d2", "sig"]
        )


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """65 rows (key, rep, n) per signature: for each chunk and each value of it left out, a hash of the other four."""
    keep = np.array([[j for j in range(CHUNK) if j != gap] for gap in range(CHUNK)])
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, CHUNKS, CHUNK)
        left = sig[:, :, keep].astype(np.uint64)
        joined = left[..., 0] | left[..., 1] << np.uint64(16) | left[..., 2] << np.uint64(32) | left[..., 3] << np.uint64(48)
        place = mix(np.arange(1, CHUNKS * CHUNK + 1, dtype=np.uint64)).reshape(1, CHUNKS, CHUNK)
        keys = mix(mix(joined) + place).view(np.int64).reshape(-1)
        reps = np.repeat(batch.column("rep").to_numpy(), CHUNKS * CHUNK)
        sizes = np.repeat(batch.column("n").to_numpy(), CHUNKS * CHUNK)
        for i in range(0, len(keys), 65536):
            part = slice(i, i + 65536)
            yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(reps[part]), pa.array(sizes[part])], ["key", "rep", "n"])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs whose signatures differ in at most RADIUS values and whose sizes allow the similarity."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, VALUES) for c in ("sig_a", "sig_b"))
        near = (x != y).sum(axis=1) <= RADIUS
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(near)), batch.column("b").filter(pa.array(near))], ["a", "b"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of the pairs whose full sets have the wanted similarity; rows carry its percent."""
    for piece in slices(batches, "text_a", 1 << 20):
        sets = []
        for column in ("text_a", "text_b"):
            hashes, begin, end = Words.of(piece.column(column), lower=True).shingles(WIDTH)
            sets.append([np.unique(hashes[lo:hi]) for lo, hi in zip(begin.tolist(), end.tolist())])
        percent = piece.column("percent").to_pylist()
        keep = []
        for x, y, p in zip(*sets, percent):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * shared >= p * (len(x) + len(y) - shared) and shared > 0)
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([piece.column("a").filter(mask), piece.column("b").filter(mask)], ["a", "b"])


def _commonness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for piece in slices(batches):
        hashes, _, _ = Words.of(piece.column("text"), lower=True).shingles(WIDTH)
        total += np.bincount((hashes >> np.uint64(48)).astype(np.int64), minlength=SLOTS)
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(total[slot])], ["slot", "c"])


def _rarest(percent: int, common: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, rep, n, comp, place): the shingles of a set that a linked set must share one of, and their places, rarest first.

    Two sets that share o shingles or more meet among the first n - o + 1 of each, whatever the order that both
    follow.  A linked pair shares at least percent * (n1 + n2) / (100 + percent); with the other set at its smallest that is percent * n / 100.
    """
    for piece in slices(batches):
        hashes, begin, end = Words.of(piece.column("text"), lower=True).shingles(WIDTH)
        out = []
        for i, (lo, hi) in enumerate(zip(begin.tolist(), end.tolist())):
            items = np.unique(hashes[lo:hi])
            n = len(items)
            items = items[np.lexsort((items, common[(items >> np.uint64(48)).astype(np.int64)]))][: n - -(-percent * n // 100) + 1]
            out.append((items.view(np.int64), np.full(len(items), i), np.full(len(items), n), np.arange(len(items))))
        gram, row, size, place = (np.concatenate(x) for x in zip(*out))
        row = pa.array(row)
        yield pa.RecordBatch.from_arrays([pa.array(gram), piece.column("rep").take(row), pa.array(size), piece.column("comp").take(row), pa.array(place)], ["gram", "rep", "n", "comp", "place"])


def _rare_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) of ``members(rep, comp, text)`` in different components that share a rare shingle."""
    counts = members.select("text").mapInArrow(_commonness, "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c"))
    common = np.zeros(SLOTS, np.int64)
    for slot, c in counts.collect():
        common[slot] = c
    shared = members.sparkSession.sparkContext.broadcast(common)
    rare = members.mapInArrow(lambda batches: _rarest(percent, shared.value, batches), "gram long, rep long, n long, comp long, place long")
    # The smaller set of a pair needs fewer: the larger one is at least as large as itself.
    small = rare.where(f"(100 + {percent}) * (n - place) >= 2 * {percent} * n").select("gram", *[F.col(c).alias(f"{c}_a") for c in ("rep", "n", "comp", "place")])
    large = rare.select("gram", *[F.col(c).alias(f"{c}_b") for c in ("rep", "n", "comp", "place")])
    # n - place shingles are left from a place on; they must be able to hold all that a linked pair shares.
    enough = " and ".join(f"(100 + {percent}) * (n_{s} - place_{s}) >= {percent} * (n_a + n_b)" for s in "ab")
    ordered = f"comp_a <> comp_b and n_a <= n_b and (n_a < n_b or rep_a < rep_b) and 100 * n_a >= {percent} * n_b and {enough}"
    return small.join(large, "gram").where(ordered).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """Group the documents whose shingle sets have a Jaccard similarity of at least ``percent`` %.

    Returns (doc_id, n_shingles, component_id, kept), a row per input row.  component_id is the
    smallest doc_id reachable over links, itself included; kept marks that document.

    Null or wordless text: empty set, linked with nothing.  Null doc_id: cannot be named in a
    group, so it is linked with nothing, component_id is null and kept true.  Rows of one doc_id
    are one document that has the links of each of its texts.  Other columns are ignored.
    ``percent`` must be at least 80: the search radius is set for such links.
    """
    if percent < 80:
        raise ValueError("links below 80 % may lie beyond the search radius")
    docs = documents.select("doc_id", "text")
    signed = written(docs.mapInArrow(_sign, "doc_id long, n long, d1 long, d2 long, sig binary"), "signatures")
    named = signed.where("n > 0 and doc_id is not null")
    classes = written(named.groupBy("d1", "d2", "n", "sig").agg(F.min("doc_id").alias("rep")), "classes")

    keys = classes.select("rep", "n", "sig").mapInArrow(_keys, "key long, rep long, n long")
    shared = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("other")).where("hub < other").select("key", "hub")
    buckets = written(keys.join(shared, "key").select("key", "rep", "n", "hub").distinct(), "buckets")

    wanted = small_side(written(buckets.select(F.col("rep").alias("doc_id")).distinct(), "wanted"))
    texts = written(docs.join(wanted, "doc_id", "left_semi").distinct(), "texts")
    sigs = classes.select("rep", "n", "sig")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a, b = (sigs.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}")) for s in "ab")
        near = pairs.join(a, "a").join(b, "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        near = written(near.select("a", "b", "sig_a", "sig_b").mapInArrow(_within, "a long, b long").distinct(), "near")
        ta, tb = (texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab")
        full = near.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b", F.lit(percent).alias("percent"))
        return full.mapInArrow(_confirm, "a long, b long").distinct()

    # A doc_id that several rows of different texts share ties their classes together.
    owner = named.select("doc_id", "d1", "d2").join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).select("doc_id", "rep")
    owner = written(owner, "owners")
    ties = owner.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("doc_id", "low")
    links = owner.join(ties, "doc_id").select(F.col("rep").alias("a"), F.col("low").alias("b"))

    links = written(links.union(confirmed(buckets.where("rep > hub").groupBy("rep").agg(F.min("hub").alias("b")).withColumnRenamed("rep", "a"))), "links")
    label = written(components(links), "components")
    for salt in range(1, HUB_ROUNDS + 1):
        open_ = _open_buckets(buckets, label)
        if salt < HUB_ROUNDS:
            hub = open_.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep", F.lit(salt)).alias("h"), "rep", "comp")).alias("m")).select("key", F.col("m.rep").alias("hub"), F.col("m.comp").alias("hub_comp"))
            met = open_.join(hub, "key").where("comp <> hub_comp").groupBy(F.col("rep").alias("a")).agg(F.min("hub").alias("b"))
        else:
            members = open_.select("rep", "comp").distinct().join(texts.withColumnRenamed("doc_id", "rep"), "rep")
            met = _rare_pairs(written(members, "members"), percent)
        links = written(label.select(F.col("id").alias("a"), F.col("component").alias("b")).union(confirmed(met)), "links")
        label = written(components(links), "components")

    grouped = signed.select("doc_id", "n", "d1", "d2").join(classes.select("d1", "d2", "rep"), ["d1", "d2"], "left")
    grouped = grouped.join(label.withColumnRenamed("id", "rep"), "rep", "left")
    linked = F.col("n") > 0
    component = F.when(linked, F.coalesce("component", "rep", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return grouped.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.expr("doc_id <=> component_id"))


def _open_buckets(buckets: DataFrame, label: DataFrame) -> DataFrame:
    """Bucket members (key, rep, n, comp) of the buckets that still hold several components."""
    comp = buckets.select("key", "rep", "n").join(label.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    split = comp.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    return written(comp.join(split, "key").select("key", "rep", "n", "comp"), "open")
