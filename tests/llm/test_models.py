"""Scores against slow forms of the same models, and against held-out labels."""

import math
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mattone.llm import languages, mixing, quality
from mattone.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def slow_cost(mixer, text):
    """Bits of one text, a byte and a bit at a time."""
    data = text.encode() + b"\xff"
    padded, begin, _ = mixing.stream(pa.array([text]))
    places = list(mixing.slots(padded))
    total = 0.0
    w = np.repeat(np.array(mixing.START, np.float32)[:, None], 8, axis=1)
    for block, size in mixing.blocks(len(data)):
        step = np.zeros_like(w)
        for i in range(block, min(block + size, len(data))):
            at, byte = begin[0] + i, data[i]
            for bit in range(8):
                half, shift = divmod(bit, 4)
                nibble = byte >> 4 if half == 0 else byte & 15
                node = (1 << shift) | (nibble >> (4 - shift))
                odds = np.array([mixer.tables[k][places[k][half][at] + node] * np.float32(mixing.STEP) for k in range(mixing.ORDERS)])
                y = byte >> (7 - bit) & 1
                z = float(np.clip((odds * w[:, bit]).sum(), -mixing.SUREST, mixing.SUREST))
                p = 1 / (1 + math.exp(-z))
                total -= math.log2(p if y else 1 - p)
                step[:, bit] += mixing.RATE * (mixing.BLOCK / size) ** mixing.DAMPED * (y - p) * odds
        w += step
    return total


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_mixing_against_slow_form(spark, docs):
    mixer = mixing.fit_mixer(docs)
    texts = ["", "a", docs.first().text[:1500], "Ünï 🎉 zzzzqqqq", "x" * 1024, "the " * 700, " ".join(r.text for r in docs.limit(5).collect())[:6000]]
    fast = mixer.cost(pa.array(texts))
    assert fast == pytest.approx([slow_cost(mixer, t) for t in texts], rel=1e-4)
    assert mixer.cost(pa.array([None, texts[2]])) == pytest.approx([fast[0], fast[2]], rel=1e-6)


def test_mixing_blocks_cover_a_text_once():
    for length in (0, 1, 16, 17, 512, 513, 40_000, 1_000_000):
        cut = list(mixing.blocks(length))
        assert all(a + n == b for (a, n), (b, _) in zip(cut, cut[1:])) and sum(n for _, n in cut) >= length
        assert all(mixing.BLOCK <= n <= mixing.LONGEST and n % mixing.BLOCK == 0 for _, n in cut)
    assert len(list(mixing.blocks(1_000_000))) < 250


def test_weights_are_carried_through_a_text(spark, docs):
    """What the weights learnt in a text's first half makes its second half cheaper than it is alone."""
    mixer = mixing.fit_mixer(docs)
    text = " ".join(r.text for r in docs.orderBy("doc_id").limit(12).collect())[:16_000]
    whole, half, rest = mixer.cost(pa.array([text, text[:8000], text[8000:]]))
    assert whole - half < rest


def test_mixing_counts(spark, docs):
    """The gathered counts are those of a plain loop, for one context."""
    some = docs.limit(5)
    data = b"".join(b"\0" * mixing.PAD + r.text.encode() + b"\xff" for r in some.collect())
    assert len(mixing.stream(pa.array([r.text for r in some.collect()]))[0]) == len(data)
    tables = mixing.fit_mixer(some).tables
    counts = np.zeros(16 << mixing.CONTEXTS[1][1], np.int64)
    for r in some.collect():
        padded, begin, end = mixing.stream(pa.array([r.text]))
        first, second = list(mixing.slots(padded))[1]
        for i in range(begin[0], end[0]):
            counts[first[i] + (padded[i] >> 4)] += 1
            counts[second[i] + (padded[i] & 15)] += 1
    assert (mixing.log_odds(counts) == tables[1]).all()


def test_tally_holds_little_beside_its_tables(monkeypatch):
    """Hashing works on pieces that fit a cache; arrays over a whole megabyte of text at once cost twice the time."""
    monkeypatch.setattr(mixing.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    texts = ["".join(chr(97 + (i * j) % 26) for j in range(2000)) for i in range(500)]
    tables = sum(4 * (16 << bits) for _, bits in mixing.CONTEXTS)
    tracemalloc.start()
    try:
        packed = pa.Table.from_batches(mixing._tally(iter([pa.record_batch({"text": texts})])))
        beside = tracemalloc.get_traced_memory()[1] - tables
    finally:
        tracemalloc.stop()
    assert beside < 64 << 20
    total = {k: sum(int(mixing._spread(r["counts"]).sum()) for r in packed.to_pylist() if r["context"] == k) for k in range(mixing.ORDERS)}
    assert set(total.values()) == {2 * sum(len(t) + 1 for t in texts)}


def test_unmet_contexts_fall_back_on_lower_orders(spark):
    """Random letters: no longer context of the text was met in training, but every byte and most pairs were."""
    assert [c for c, _ in mixing.CONTEXTS] == [1, 2, 3, 5, "word"] and mixing.CONTEXTS[2][1] == 20 and mixing.BLOCK == 16
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789-_.:"))
    text = lambda n: "".join(rng.choice(letters, n))
    mixer = mixing.fit_mixer(spark.createDataFrame([(text(1000),) for _ in range(4)], "text string"))
    unseen = text(1000)
    assert mixer.cost(pa.array([unseen]))[0] / len(unseen) < 7


def test_a_first_byte_has_probability_one(spark, docs):
    """Over all first bytes the costs of the first eight decisions sum up to one."""
    mixer = mixing.fit_mixer(docs)
    total = 0.0
    for byte in range(256):
        p = 1.0
        padded = np.array([0] * mixing.PAD + [byte], np.uint8)
        places = [(a[-1], b[-1]) for a, b in mixing.slots(padded)]
        for bit in range(8):
            z = sum(mixing.START[k] * mixing.STEP * mixer.tables[k][places[k][bit // 4] + mixing._NODES[byte][bit]] for k in range(mixing.ORDERS))
            q = 1 / (1 + math.exp(-max(-mixing.SUREST, min(mixing.SUREST, z))))
            p *= q if byte >> (7 - bit) & 1 else 1 - q
        total += p
    assert total == pytest.approx(1, abs=1e-6)


def test_text_scores(spark):
    rows = QUERIES["op2_context_mixing"](spark, MIDDLE).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    import re
    from collections import Counter

    tokens = {d: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), None] for d, t in texts.items()}
    count = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    assert len(rows) == len(texts)
    for r in rows:
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(w in count for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > 1.2 * sum(r.base_score for r in unseen)
    monkey = mixing.FREQUENT
    try:
        mixing.FREQUENT = 50  # nearly all tokens by the join
        docs = spark.read.parquet(f"{SMALL}/documents.parquet")
        few = {r.doc_id: r for r in mixing.text_scores(docs, F.lit(True)).collect()}
    finally:
        mixing.FREQUENT = monkey
    for r in mixing.text_scores(docs, F.lit(True)).collect():
        assert few[r.doc_id].base_score == pytest.approx(r.base_score, rel=1e-9) and few[r.doc_id].n_known == r.n_known


def test_language_accuracy(spark):
    got = QUERIES["op8_language_mixture"](spark, MIDDLE).where("held_out").join(spark.read.parquet(f"{MIDDLE}/documents.parquet"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)


def test_language_mixture(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = languages.fit_languages(docs)
    one = {r.lang: r.text for r in docs.where("length(text) > 3000 and not text rlike '!!|###|[|]'").dropDuplicates(["lang"]).collect()}
    mixed = spark.createDataFrame([(1, one["en"][:2000] + " " + one["de"][:2000]), (2, one["fr"][:2000]), (3, "12 34 !?"), (4, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in languages.language_mixtures(mixed, model).collect()}
    assert set(rows[1].languages) == {"en", "de"} and all(0.35 < p < 0.65 for p in rows[1].languages.values())
    assert set(rows[2].languages) == {"fr"} and rows[2].score == pytest.approx(1)
    assert [(rows[i].lang_pred, rows[i].score) for i in (3, 4)] == [("und", 0.0)] * 2


def test_em_against_slow_form(spark):
    rng = np.random.default_rng(8)
    p = rng.random((languages.BINS, 3)) + 0.01
    model = languages.Languages(["a", "b", "c"], p / p.sum(axis=0))
    texts = pa.array(["some words here", "", None, "x", "others " * 30])
    bins, offsets = languages.trigrams(texts)
    got = model.mixtures(texts)
    for i in range(len(texts)):
        own = model.p[bins[offsets[i] : offsets[i + 1]]]
        if not len(own):
            assert (got[i] == 0).all()
            continue

        def em(allowed):
            share = allowed / allowed.sum()
            for _ in range(languages.STEPS):
                part = own * share
                share = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
            return share, np.log(own @ share).sum()

        allowed = np.ones(3)
        share, fit = em(allowed)
        for _ in range(2):
            fewer = allowed.copy()
            fewer[np.where(allowed > 0, share, 2).argmin()] = 0
            other, less = em(fewer)
            if less + languages.PENALTY * np.log(max(len(own), 2)) / 2 < fit:
                break
            allowed, share, fit = fewer, other, less
        assert got[i] == pytest.approx(share)


def test_quality_held_out(spark):
    got = QUERIES["op4_quality_classifier"](spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.95 * len(good)
    assert sum(r.predicted for r in bad) <= 0.2 * len(bad)


def test_pool_adjacent():
    got = quality.pool_adjacent(np.array([0.0, 0.6, 0.2, 0.5, 1.0]), np.array([1, 1, 3, 2, 1]))
    assert got == pytest.approx([0, 0.3, 0.3, 0.5, 1])
    assert len(quality.pool_adjacent(np.zeros(0), np.zeros(0))) == 0


def test_normal_equations_are_a_ridge_fit(spark):
    """Summed over partitions they give the weights that all rows at once give."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(int)
    rows = spark.createDataFrame([(4 * i, [float(v) for v in r]) for i, r in enumerate(x)], "doc_id long, x array<double>").repartition(5)
    labels = spark.createDataFrame([(4 * i, int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    model = quality.fit_quality(rows, labels)
    late = np.array([zlib.crc32(str(4 * i).encode()) % 4 == 3 for i in range(300)])
    z = model.features(x[~late])
    penalty = quality.RIDGE * len(z) / quality.FEATURES * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-9
    assert model.weights == pytest.approx(np.linalg.solve(z.T @ z + penalty, z.T @ y[~late]), abs=1e-6)
    assert np.mean((model.score(x) > 0.5) == y) > 0.85


def test_texts_without_a_letter_have_no_language(spark):
    """Numerals and signs are no letters, whatever their shape."""
    from mattone.llm import languages

    rows = [(1, "½ ² ① Ⅷ 123 _"), (2, None), (3, ""), (4, "a"), (5, "ª"), (6, "漢")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    training = spark.createDataFrame([(9, "the cat sat on the mat", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in languages.language_mixtures(docs, languages.fit_languages(training)).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and got[4] == "en"
