"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

All of it is DataFrame expressions.  A text is its lower-cased words; an item of L words is a bag of
L - 4 five-word shingles (of the whole sequence if it has fewer words), each weighing as often as it occurs.
A document holds an item if one of its windows of L words has a weighted Jaccard similarity, sum of the smaller
weights over sum of the larger, of at least 0.8 with it.  A text of fewer than L words is one window as a whole.

1. Lossless filters choose the windows.  A similar window misses at most x of the item's m shingles, so
   looking up every g-th shingle of a document, g = m // (x + 1), meets one that the item has.  In documents so
   found, sliding a window right until it begins with a shared shingle, or the text ends, loses nothing.  A whole text
   of n < m shingles can be similar only if n >= 0.8 m; g is the smallest that any such n needs.
2. Each window gets a 64-bit SimHash.  Two fingerprints within RADIUS = 20 differ in at most 2 bits
   of one of 7 blocks; an item's blocks are stored with all such errors, so every pair within
   the radius meets in an equi-join on (L, block, value).  At similarity 0.8 the expected distance is 9.7
   (standard deviation 2.9): the radius is 3.6 deviations above it.  Bags of unequal sizes have a higher cosine at the
   same similarity, so no larger distance, but in bags of a few shingles ties of bit counts add to it: whole texts shorter
   than an item of at most TINY words are paired with it by any shingle they share instead.
3. Pairs within the radius are compared by their whole bags.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.llm.scratch import small_side, written

WIDTH = 5
RADIUS = 20
BLOCKS = (9, 9, 9, 9, 9, 9, 10)
ERRORS = RADIUS // len(BLOCKS)
TINY = 16
_PAIR = 0x0000000100000001


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")


def shingles(word: Column, width: int, stride: int = 1) -> Column:
    """Hashes of the shingles at positions 0, stride, 2 * stride ...; ``word`` is bound once, not per shingle."""

    def of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - width, F.lit(stride))
        made = F.transform(at, lambda i: F.xxhash64(F.lit(width), *[F.get(w, i + j) for j in range(width)]))
        return F.when(F.size(w) >= width, made).otherwise(F.array().cast("array<bigint>"))

    return F.transform(F.array(word), of)[0]


def _fingerprint(m: Column) -> Column:
    """From sums of pairs of bit counts: the bits that more than half of the weight has set."""
    bits = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"s{k}").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(F.col(f"s{k}"), 32)
        for count, place in ((low, k), (high, k + 32)):
            bits = bits.bitwiseOR(F.when(2 * count > m, F.shiftleft(F.lit(1).cast("long"), place)).otherwise(F.lit(0).cast("long")))
    return bits


def simhash(bags: DataFrame, keys: list[str]) -> DataFrame:
    """keys and ``fp`` of every row of ``bags(keys, bag)``; keys must tell the rows apart, or rows have equal bags.

    64 counters are summed as 32 longs of two 32-bit halves, inside each task before the shuffle.
    """
    gram = F.col("gram")
    rows = bags.select(*keys, F.explode("bag").alias("gram"))
    sums = [F.sum(F.shiftrightunsigned(gram, k).bitwiseAND(_PAIR)).alias(f"s{k}") for k in range(32)]
    return rows.groupBy(*keys).agg(F.count("*").alias("weight"), *sums).select(*keys, _fingerprint(F.col("weight")).alias("fp"))


def _blocks(fp: Column) -> list[tuple[int, int, Column]]:
    out, offset = [], 0
    for number, width in enumerate(BLOCKS):
        out.append((number, width, F.shiftrightunsigned(fp, offset).bitwiseAND((1 << width) - 1)))
        offset += width
    return out


def _block_keys(fp: Column, errors: int) -> Column:
    """(block, value) structs: each block's value with up to ``errors`` of its bits turned."""
    parts = []
    for number, width, value in _blocks(fp):
        masks = [sum(1 << b for b in turned) for e in range(errors + 1) for turned in combinations(range(width), e)]
        parts += [F.struct(F.lit(number).alias("block"), value.bitwiseXOR(F.lit(mask).cast("long")).alias("value")) for mask in masks]
    return F.array(*parts)


def _shared_weight(x: Column, y: Column) -> Column:
    """Weight two bags have in common; the quadratic form is for bags with repeats only."""
    plain = (F.size(F.array_distinct(x)) == F.size(x)) & (F.size(F.array_distinct(y)) == F.size(y))
    each = F.transform(F.array_intersect(x, y), lambda g: F.least(F.size(F.filter(x, lambda v: v == g)), F.size(F.filter(y, lambda v: v == g))))
    return F.when(plain, F.size(F.array_intersect(x, y))).otherwise(F.aggregate(each, F.lit(0), lambda total, v: total + v))


def least_size(m: int, similarity: float) -> int:
    """The fewest shingles a text can have that is similar to an item of m."""
    return ceil(round(m * similarity, 9))


def stride_for(m: int, similarity: float) -> int:
    """The largest g for which n consecutive places always hold a multiple of g at which a similar window of n agrees, n up to m."""
    missed = lambda n: n - ceil(round((m + n) * similarity / (1 + similarity), 9))
    return max(1, min(n // (missed(n) + 1) for n in range(max(1, least_size(m, similarity)), m + 1)))


def find_items(documents: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(doc_id, item_id, similarity) of every document and item it holds, with the best window's similarity.

    Null, empty or wordless texts hold nothing and are held by nothing; a document shorter than an item
    is compared as a whole.  Rows without a doc_id or item_id cannot be named and are left out.  Rows of one id count
    together.  Empty tables give an empty result; other columns are ignored.
    """
    docs = documents.where("doc_id is not null").select("doc_id", "text")
    w = F.col("w")
    items = benchmark.where("item_id is not null").select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    width = F.least(F.size(w), F.lit(WIDTH))
    bag = shingles(w, WIDTH)
    for k in range(1, WIDTH):
        bag = F.when(F.size(w) == k, shingles(w, k)).otherwise(bag)
    items = written(items.select("item_id", F.size(w).alias("len"), width.alias("width"), bag.alias("bag")).withColumn("m", F.size("bag")).distinct(), "items")

    # One number per shingle width, at most five.
    strides = {r["width"]: min(stride_for(m, similarity) for m in r["ms"]) for r in items.groupBy("width").agg(F.collect_set("m").alias("ms")).collect()}
    if not strides:
        return docs.select("doc_id", F.lit(None).cast("long").alias("item_id"), F.lit(None).cast("double").alias("similarity")).limit(0)
    grams = small_side(written(items.select(F.explode("bag").alias("gram"), "len", "width", "m").distinct(), "item-grams"))

    listed = docs.select("doc_id", words(F.col("text")).alias("w"))
    probes = F.flatten(F.array(*[shingles(w, k, g) for k, g in strides.items()]))
    met = listed.select("doc_id", F.explode(probes).alias("gram")).join(grams.select("gram"), "gram", "left_semi")
    met = small_side(written(met.select("doc_id").distinct(), "suspect-ids"))
    suspects = written(docs.join(met, "doc_id", "left_semi").distinct(), "suspects")

    # Windows that begin with a shared shingle, and the text's last one if a shared shingle lies in it; whole texts that are shorter.
    by_width = [suspects.select("doc_id", F.lit(k).alias("width"), shingles(words(F.col("text")), k).alias("all")) for k in strides]
    arrays = by_width[0]
    for more in by_width[1:]:
        arrays = arrays.union(more)
    arrays = written(arrays.withColumn("text_key", F.xxhash64("all")), "suspect-shingles")
    places = arrays.select("doc_id", "text_key", "width", F.size("all").alias("n"), F.posexplode("all").alias("pos", "gram"))
    enough = F.col("n") >= F.ceil(F.round(F.col("m") * F.lit(similarity), 9))
    starts = places.join(grams, ["gram", "width"]).where(enough).groupBy("doc_id", "text_key", "width", "len", "m")
    starts = starts.agg(F.collect_set(F.greatest(F.lit(0), F.least(F.col("pos"), F.col("n") - F.col("m")))).alias("starts"))
    # One row per start before any window is cut: no row holds more than its text and one window.
    placed = starts.join(arrays, ["doc_id", "text_key", "width"]).select("doc_id", "text_key", "len", "m", "all", F.explode("starts").alias("start"))
    windows = written(placed.select("doc_id", "text_key", "len", "start", F.slice("all", F.col("start") + 1, F.col("m")).alias("bag")).distinct(), "windows")

    place = ["doc_id", "text_key", "len", "start"]
    probe = simhash(windows, place).select(*place, "fp", F.explode(_block_keys(F.col("fp"), 0)).alias("k")).select(*place, "fp", "k.block", "k.value")
    prints = simhash(items, ["item_id", "len"]).withColumnRenamed("fp", "item_fp")
    index = prints.select("item_id", "len", "item_fp", F.explode(_block_keys(F.col("item_fp"), ERRORS)).alias("k"))
    index = small_side(written(index.select("item_id", "len", "item_fp", "k.block", "k.value"), "item-index"))
    near = probe.join(index, ["len", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    tiny = windows.where((F.col("len") <= TINY) & (F.size("bag") < F.col("len") - (WIDTH - 1))).select(*place, F.explode("bag").alias("gram"))
    held = items.where(F.col("len") <= TINY).select("item_id", "len", F.explode("bag").alias("gram"))
    near = near.select(*place, "item_id").union(tiny.join(held, ["len", "gram"]).select(*place, "item_id")).distinct()

    compared = near.join(windows, place).join(items.select("item_id", "len", F.col("bag").alias("item_bag"), "m"), ["item_id", "len"])
    compared = compared.withColumn("shared", _shared_weight(F.col("bag"), F.col("item_bag")))
    score = F.col("shared") / (F.size("bag") + F.col("m") - F.col("shared"))
    return compared.select("doc_id", "item_id", score.alias("similarity")).where(F.col("similarity") >= similarity).groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))
