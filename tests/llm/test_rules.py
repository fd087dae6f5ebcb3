"""Thresholds from sketches: each rule rejects what only it can reject, and groups have limits of their own."""

import random

import pytest

from mattone.llm import rules


def prose(seed, lines=60, capitals=1, letters=5):
    """Lines of ten words that never repeat; capitals of them begin with a capital letter."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(max(1, letters + r.choice((-1, 0, 0, 1)))))
    out = [[word() for _ in range(10)] for _ in range(lines)]
    for n in range(capitals):
        out[n % lines][n // lines] = out[n % lines][n // lines].capitalize()
    return [" ".join(line) for line in out]


def group(first, source, letters, spread):
    """Sixty texts, every third with one to three repeated lines; their words vary in length by the spread."""
    rows = []
    for i in range(60):
        lines = prose(first + i, capitals=4 + i % 3, letters=letters + (i % 5 - 2) * spread)
        if i % 3 == 0:
            lines += lines[: 1 + i % 9 // 3]
        rows.append((first + i, "\n".join(lines), "en", source))
    return rows


PLANTED = {
    "word_chars_mean": prose(1, capitals=5, letters=14),
    "symbol_share": [line[:-3] + "#$%" for line in prose(2, capitals=5)],
    "upper_share": prose(3, capitals=150),
    "dup_line_share": [x for line in prose(4, capitals=5) for x in (line, "again")],
}
# Four lines with the same sixty words but for the first: they repeat, no line does.
again = " ".join(prose(6, lines=6, capitals=2))
PLANTED["repeat_share"] = prose(5, lines=65, capitals=16) + [f"{w} {again}" for w in ("first", "other", "third", "forth")]


@pytest.fixture(scope="module")
def judged(spark):
    rows = group(1000, "narrow", 5, 0) + group(2000, "wide", 6, 1)
    # A hundred texts whose sources are too small for limits of their own fill the language's sketch of repeats.
    small = [prose(3000 + i, capitals=4 + i % 3) for i in range(100)]
    rows += [(3000 + i, "\n".join(lines + lines[57 + i % 3 :]), "en", f"s{i}") for i, lines in enumerate(small)]
    rows += [(n, "\n".join(lines), "en", "narrow") for n, lines in enumerate(PLANTED.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    return {r.doc_id: r for r in rules.judge(docs).collect()}


@pytest.mark.parametrize("n, rule", list(enumerate(PLANTED)))
def test_each_rule_rejects_a_text_that_no_other_does(judged, n, rule):
    assert judged[n].broken == [rule] and not judged[n].base_failed and not judged[n].kept


def test_plain_texts_stay(judged):
    assert [(i, r.broken) for i, r in judged.items() if i >= len(PLANTED) and not r.kept] == []


def test_groups_of_another_spread_have_other_limits(spark):
    docs = spark.createDataFrame(group(1000, "narrow", 5, 0) + group(2000, "wide", 6, 1), "doc_id long, text string, lang string, source string")
    limits = {r.source: r for r in rules.thresholds(rules.measures(docs)).collect()}
    narrow, wide = limits["narrow"], limits["wide"]
    assert wide.high_word_chars_mean - wide.low_word_chars_mean > 3 * (narrow.high_word_chars_mean - narrow.low_word_chars_mean)
    assert narrow.high_upper_share != wide.high_upper_share


def test_limits_are_quartiles(spark):
    """One group, exact in the sketch: median and quartiles by rank; a share equal to a limit is kept."""
    rows = group(1000, "narrow", 5, 0)
    measured = rules.measures(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    shares = sorted(r.n_upper / r.word_chars for r in measured.collect())
    low, mid, high = (shares[-(-len(shares) * q // 4) - 1] for q in (1, 2, 3))
    limit = rules.thresholds(measured).first()
    assert limit.low_upper_share == pytest.approx(mid - 8 * (mid - low) - rules.EPSILON, abs=1e-12)
    assert limit.high_upper_share == pytest.approx(mid + 8 * (high - mid) + rules.EPSILON, abs=1e-12)
    at = spark.createDataFrame([(1, "en", "narrow", 100, 400, 0, 0, 0, 4, 2, False)], measured.schema)
    limits = rules.thresholds(measured).selectExpr("lang", "source", *[f"0D low_{r}" for r in rules.FENCE], *[f"{4.0 if r == 'word_chars_mean' else 0.005}D high_{r}" for r in rules.FENCE])
    assert rules.verdicts(at, limits).first().broken == []
    assert rules.verdicts(at.selectExpr(*[c if c != "n_upper" else "3L n_upper" for c in at.columns]), limits).first().broken == ["upper_share"]
