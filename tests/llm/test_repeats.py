"""Periodic runs, repeated passages and vector codes against brute force."""

import hashlib
import os
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mattone.llm import scratch, substrings
from mattone.llm.fm_index import FMIndex
from mattone.llm.periodic_runs import find_runs, word_runs
from mattone.llm.queries import QUERIES
from mattone.llm.vector_codes import Tree, assign, squares, vector_codes

SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs_of(x):
    """Maximal stretches per period, those of a smaller period left out."""
    n, out = len(x), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q) and all(any(x[i + t] != x[i + t + r] for t in range(length - r)) for r in range(1, q)):
                out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbered(x):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in x], np.int64)


def test_runs_by_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        x, letters = [], rng.choice([1, 2, 2, 3, 4])
        while len(x) < rng.randrange(0, 60):
            x += [rng.randrange(letters) for _ in range(rng.randrange(1, 6))] * rng.choice([1, 1, 2, 4, 5, 9])
        x = x[: rng.randrange(len(x) - 2, len(x) + 1)] if len(x) > 2 else x
        assert word_runs(numbered(x)) == runs_of(x), x


def test_runs_of_the_table(spark):
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        w, h = words(r.text), zlib.crc32(str(r.doc_id).encode())
        n, g = len(w), h // 10
        if n > 2000:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = runs_of(w)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert got[r.doc_id] == (r.doc_id, len(runs), *shown, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_a_long_periodic_text(spark):
    text = " ".join(f"w{i % 37}" for i in range(50_000)) + "\tend \n" + "again " * 50_000
    row = find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 50_000, 37), (50_001, 50_000, 1)]
    assert row.collapsed == " ".join(f"w{i}" for i in range(37)) + " end again"


def first_windows(rows):
    """Words kept of each (doc_id, text), rows of one doc_id told apart by their place."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            first[key] = min(first.get(key, (doc, s)), (doc, s))
    out = []
    for doc, text in rows:
        w = words(text)
        gone = {i for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] < (doc, s) for i in range(s, s + 20)}
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


@pytest.mark.parametrize("spread", [2, 5, 2048])
def test_repeated_passages_by_brute_force(spark, monkeypatch, spread):
    """Copies, passages in many texts, periodic texts and rows of one doc_id; a small spread deals every hot anchor in parts."""
    monkeypatch.setattr(substrings, "SPREAD", spread)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (19, 20, 21, 50, 120)]
    rows = []
    for i in range(220):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        if i % 11 == 0:
            w += [rng.choice(vocabulary) for _ in range(rng.randrange(1, 7))] * rng.randrange(2, 15)
        rows.append((i * 37 % 211, "\t ".join(w)))
    rows += rows[:9] + [(rows[5][0], rows[6][1])] + [(1000 + i, rows[7][1]) for i in range(30)]
    got = substrings.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == first_windows(rows)


def test_fm_index_counts_and_matches():
    rng = np.random.default_rng(5)
    passages = [rng.integers(1, 4, n) for n in rng.integers(0, 40, 60)]
    text = np.concatenate([np.append(p, 0) for p in passages])
    index, _ = FMIndex.build(text, 6)
    flat = "".join(map(str, text))
    for _ in range(200):
        pattern = rng.integers(1, 5, rng.integers(1, 8))
        shown = "".join(map(str, pattern))
        assert index.count(pattern) == sum(flat.startswith(shown, i) for i in range(len(flat)))
    # Streamed texts that the index does not hold.
    other = rng.integers(1, 5, 400)
    low, high = index.matches(other, np.array([0, 150]), np.array([150, 400]))
    for i in range(400):
        end = 150 if i < 150 else 400
        shown = "".join(map(str, other[i : i + 6])) if i + 6 <= end else "-"
        assert high[i] - low[i] == sum(flat.startswith(shown, k) for k in range(len(flat)))


def codes_by_brute_force(rows):
    rows = sorted(rows)
    whole = np.floor(1024 * np.array([r[1] for r in rows], np.float64)).astype(np.int64)
    code, error, books = [], np.zeros(len(rows), np.int64), []
    for part in np.split(whole, 4, axis=1):
        entries = part[:256].copy()
        for turn in range(5):
            far = ((part[:, None, :] - entries[None]) ** 2).sum(axis=2)
            own = far.argmin(axis=1)
            if turn < 4:
                for k in np.unique(own):
                    entries[k] = part[own == k].sum(axis=0) // (own == k).sum()
        code.append(own)
        error += far.min(axis=1)
        books.append(entries)
    flat = ",".join(str(x) for e in books for x in e.reshape(-1))
    return {r[0]: (bytes(c[i] for c in code).hex(), int(error[i])) for i, r in enumerate(rows)}, hashlib.sha256(flat.encode()).hexdigest()


def test_codes_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, books = codes_by_brute_force(rows)
    got = QUERIES["op11_cover_tree_lloyd"](spark, SMALL).collect()
    assert {r.vec_id: (r.code, r.error) for r in got} == want and {r.codebooks_sha256 for r in got} == {books}
    sums = {}
    for vec_id, _, label in rows:
        sums[label] = sums.get(label, 0) + want[vec_id][1]
    assert all(r.label_error == sums[label] for r in got for vec_id, _, label in rows if vec_id == r.vec_id)


def test_codes_with_ties_and_clusters(spark):
    """Few distinct vectors, many times over: equal distances everywhere, and subtrees that are assigned as a whole."""
    rng = np.random.default_rng(8)
    centres = rng.integers(-3, 4, (12, 8)) / 4
    rows = [(i, (centres[rng.integers(12)] + rng.integers(0, 2, 8) / 1024).tolist()) for i in range(1500)]
    want, books = codes_by_brute_force(rows)
    codes, fitted = vector_codes(spark.createDataFrame([(*r, None) for r in rows], "vec_id long, embedding array<double>, label int").repartition(3))
    assert {r.vec_id: (r.code.hex(), r.error) for r in codes.collect()} == want and fitted.sha256() == books


def test_whole_subtrees_and_ambiguous_vectors():
    rng = np.random.default_rng(9)
    centres = rng.integers(-500, 500, (40, 6)).astype(float)
    points = centres[rng.integers(0, 40, 3000)] + rng.integers(-3, 4, (3000, 6))
    tree = Tree.from_bytes(Tree.grow(points).to_bytes())
    ordered = points[tree.order]
    begin, end, entry, at, chosen = assign(tree, ordered, centres)
    own = np.full(3000, -1)
    for a, b, e in zip(begin, end, entry):
        own[a:b] = e
    assert (own[at] == -1).all()
    own[at] = chosen
    assert (own == squares(ordered, centres).argmin(axis=1)).all() and len(at) < 300
    big = np.array([[int(x) << 80 for x in p] for p in points[:300]], dtype=object)
    far = np.array([[int(x) << 80 for x in p] for p in centres], dtype=object)
    tree = Tree.grow(big.astype(np.float64))
    begin, end, entry, at, chosen = assign(tree, big[tree.order], far)
    for a, b, e in zip(begin, end, entry):
        assert (squares(points[tree.order[a:b]], centres).argmin(axis=1) == e).all()
    assert (squares(points[tree.order[at]], centres).argmin(axis=1) == chosen).all()


def test_a_finished_step_leaves_no_shuffle_files(spark):
    """What a step shuffled goes at its end, not when the driver's garbage is next collected; the session's settings stay."""

    def shuffled():
        folders = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
        return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(scratch.SHUFFLE_CLEANUP)
    counts = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.collect_set("id").alias("ids"))
    table = scratch.written_alone(counts.join(spark.range(100).withColumnRenamed("id", "k").hint("merge"), "k"), "alone")
    end = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert table.count() == 100 and spark.conf.get(scratch.SHUFFLE_CLEANUP) == setting
