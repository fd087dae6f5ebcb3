"""Patterns against their regular expressions, and what the field adds."""

import random
import re

from mattone.llm import personal_data as pd_

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_pattern(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")) or kind == "phone" and 8 <= len(digits) <= 15
            if kind == "card" and 16 <= len(digits) <= 19:
                total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
                ok = total % 10 == 0
            if ok:
                out.append((kind, *m.span()))
    return out


def test_patterns():
    rng = random.Random(9)
    for alphabet in ("a@.b-", "12.3", "12 -5", "+1 ()2-.", "a1@. +-()é", "4111 "):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40)))
            assert pd_.base_spans(text) == by_pattern(text), text
    for text in ("4111111111111111", "x 4111 1111 1111 1111 y", "+1 (375) 555-4393", "a.b@c-d.example.com.", "256.1.1.1 1.2.3.4.5"):
        assert pd_.base_spans(text) == by_pattern(text)


def test_linear_on_long_runs():
    assert pd_.base_spans("a" * 300_000 + "@" + "9" * 300_000 + "." * 1000) == []


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(400):
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        mail = f"user{rng.randrange(9999)}@mail.example.org"
        rows.append((i, f"call {phone} or write to {mail} now, version 3.0 of {rng.randrange(1900, 2020)} and host 10.{i % 250}.3.4 here"))
    return rows


def test_consistency_within_a_document(spark):
    """A number that is a phone in one place is one in another, where the pattern cannot tell; elsewhere it is none."""
    rows = corpus() + [(1000, "reach +1 (375) 555-4393 first. Later dial 13755554393 again"), (1001, "order 13755554399 was sent"), (1002, "plain words only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: ([tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in pd_.personal_data(docs).collect()}
    assert got[1002] == ([], [])
    base, spans = got[1000]
    assert base == [("phone", 6, 23)] and set(base) <= set(spans)
    assert got[1001] == ([], [])
    assert all(set(b) <= set(s) for b, s in got.values())
    text = pd_.redact(docs).where("doc_id = 1000").first().text
    assert "+1 (375)" not in text and "<PHONE>" in text
