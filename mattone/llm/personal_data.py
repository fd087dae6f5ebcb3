"""Personal data by a skip-chain conditional random field over the tokens that hold digits or an ``@``.

Labels are O, email, ip, card and phone.  Neighbouring tokens share a chain potential; occurrences of the same or
a similar token anywhere in the document are tied, each to the next, by a skip potential.  Loopy
sum-product messages, damped, give each token's label probabilities, so an entity
recognised in one place is recognised in the others.

Patterns find the sure spans; they are the labels the potentials are estimated from, by counts over all documents,
and stay observed during inference.  The field adds spans, it takes none away.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
ROUNDS, DAMPING, OBSERVED = 12, 0.5, 12.0
CHAIN, SKIP = 0, 1

_ANY = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_BEGINS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+(")
_ENDS = _BEGINS - {"+", "("} | {")"}

Span = tuple[str, int, int]


def digits_of(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, ``@`` and dotted domain, found from each ``@`` so that time stays linear."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield "email", begin, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind and start; positions are code points, the end is exclusive."""
    if not _ANY.search(text):
        return []
    spans = list(_emails(text))
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        number = digits_of(m.group())
        if 16 <= len(number) <= 19 and luhn(number):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return spans


@dataclass
class Tokens:
    """The words of a text that hold a digit or an ``@``."""

    start: list[int]
    end: list[int]
    place: list[int]
    shape: list[str]
    key: list[str | None]
    label: list[int]

    @classmethod
    def of(cls, text: str, base: list[Span]) -> Tokens:
        out = cls([], [], [], [], [], [])
        cover = sorted((s, e, LABELS.index(k)) for k, s, e in base)
        open_: list[tuple[int, int, int]] = []
        j = 0
        for place, m in enumerate(_WORD.finditer(text)):
            word = m.group()
            if not _ANY.search(word):
                continue
            while j < len(cover) and cover[j][0] < m.end():
                open_.append(cover[j])
                j += 1
            open_ = [c for c in open_ if c[1] > m.start()]
            begin = next((i for i, c in enumerate(word) if c in _BEGINS), 0)
            stop = next((i for i in range(len(word), begin, -1) if word[i - 1] in _ENDS), len(word))
            core = word[begin:stop]
            out.start.append(m.start() + begin)
            out.end.append(m.start() + begin + len(core))
            out.place.append(place)
            out.shape.append(shape(core))
            out.key.append(similar(core))
            out.label.append(min((c[2] for c in open_), default=0))
        return out

    def edges(self) -> np.ndarray:
        """(i, j, type): neighbours in the text, and each token's next same or similar one; at most two per token."""
        rows = [(i, i + 1, CHAIN) for i in range(len(self.place) - 1) if self.place[i + 1] == self.place[i] + 1]
        last: dict[str, int] = {}
        for i, key in enumerate(self.key):
            if key is not None:
                if key in last:
                    rows.append((last[key], i, SKIP))
                last[key] = i
        return np.array(rows, dtype=np.int64).reshape(-1, 3)


def _step(n: int) -> str:
    """A count as one of ten steps, so that shapes stay few."""
    return str(n) if n <= 4 else "56"[n - 5] if n <= 6 else "7" if n <= 9 else "8" if n <= 15 else "9" if n <= 19 else "+"


def shape(core: str) -> str:
    """What a token looks like; one of some thousands of strings, whatever the token."""
    number = digits_of(core)
    dots = core.count(".")
    marks = "".join(c for c in "@+()-" if c in core)
    octets = dots == 3 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in core.split("."))
    card = 16 <= len(number) <= 19 and luhn(number)
    letters = any(c.isalpha() for c in core)
    return f"{marks}|{_step(len(number))}|{min(dots, 4)}|{'o' if octets else ''}{'c' if card else ''}{'l' if letters else ''}"


def similar(core: str) -> str | None:
    """Tokens with this key in common are tied: the address in lower case, or five digits and more however written."""
    if "@" in core:
        return core.lower()
    number = digits_of(core)
    if len(number) < 5 or any(c.isalpha() for c in core):
        return None
    return ".".join(_DIGITS.findall(core)) if core.count(".") >= 2 else number


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What potentials are estimated from: labels by shape, and label pairs by type of edge."""
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if not text or not _ANY.search(text):
                continue
            tokens = Tokens.of(text, base_spans(text))
            seen.update(("shape", s, 0, l) for s, l in zip(tokens.shape, tokens.label))
            seen.update((("chain", "skip")[t], "", tokens.label[i], tokens.label[j]) for i, j, t in tokens.edges().tolist())
    rows = [(*k, n) for k, n in seen.items()]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["part", "shape", "l1", "l2", "n"])


@dataclass
class Field:
    """Log potentials: of labels given a token's shape, and of label pairs over chain and skip edges."""

    node: dict[str, np.ndarray]
    other: np.ndarray
    pair: np.ndarray

    @classmethod
    def from_counts(cls, rows: list) -> Field:
        by_shape: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(LABELS)))
        pairs = np.zeros((2, len(LABELS), len(LABELS)))
        for part, shape_, l1, l2, n in rows:
            if part == "shape":
                by_shape[shape_][l2] += n
            else:
                pairs[("chain", "skip").index(part)][l1, l2] += n
        prior = np.full(len(LABELS), 0.02)
        prior[0] = 0.92
        node = {s: np.log((c + prior) / (c.sum() + 1)) for s, c in by_shape.items()}
        pairs = pairs + pairs.transpose(0, 2, 1) + 0.1 + 2.0 * np.eye(len(LABELS))
        joint = pairs / pairs.sum(axis=(1, 2), keepdims=True)
        single = joint.sum(axis=1)
        # The lift of a pair over independence, bounded so that no edge outweighs an observed label.
        lift = np.log(joint / (single[:, :, None] * single[:, None, :]))
        return cls(node, np.log(prior), np.clip(lift, -4, 4))

    def marginals(self, tokens: Tokens) -> np.ndarray:
        """Label probabilities of each token after ROUNDS of damped messages."""
        unary = np.array([self.node.get(s, self.other) for s in tokens.shape])
        seen = np.array(tokens.label)
        unary[np.flatnonzero(seen), seen[seen > 0]] += OBSERVED
        edges = tokens.edges()
        belief = unary
        if len(edges):
            tail = np.concatenate([edges[:, 0], edges[:, 1]])
            head = np.concatenate([edges[:, 1], edges[:, 0]])
            back = np.roll(np.arange(len(tail)), len(edges))
            pair = self.pair[np.concatenate([edges[:, 2], edges[:, 2]])]
            sent = np.zeros((len(tail), len(LABELS)))
            for _ in range(ROUNDS):
                out = (belief[tail] - sent[back])[:, :, None] + pair
                top = out.max(axis=1)
                out = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                out -= out.max(axis=1, keepdims=True)
                sent = DAMPING * sent + (1 - DAMPING) * out
                belief = unary.copy()
                np.add.at(belief, head, sent)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def fit_field(documents: DataFrame) -> Field:
    """Potentials from the counts of all documents; shapes and labels bound what comes to the driver."""
    counts = documents.select("text").mapInArrow(_counts, "part string, shape string, l1 int, l2 int, n long")
    return Field.from_counts([tuple(r) for r in counts.groupBy("part", "shape", "l1", "l2").agg(F.sum("n").alias("n")).collect()])


LEAST_DIGITS = {"email": 0, "ip": 4, "card": 12, "phone": 7}


def all_spans(text: str | None, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of one text; both are ordered by kind, then start."""
    if not text or not _ANY.search(text):
        return [], []
    base = base_spans(text)
    tokens = Tokens.of(text, base)
    if not len(tokens.edges()) and all(l or field.node.get(s, field.other)[0] > np.log(0.5) for l, s in zip(tokens.label, tokens.shape)):
        return base, base  # single tokens keep the label their shape gives them
    best = field.marginals(tokens)
    label = np.where(best.max(axis=1) > 0.5, best.argmax(axis=1), 0)
    added: list[Span] = []
    i = 0
    while i < len(label):
        j = i + 1
        if label[i] and not tokens.label[i]:
            kind = LABELS[label[i]]
            while kind in ("card", "phone") and j < len(label) and label[j] == label[i] and not tokens.label[j] and tokens.place[j] == tokens.place[j - 1] + 1:
                j += 1
            span = (kind, tokens.start[i], tokens.end[j - 1])
            if len(digits_of(text[span[1] : span[2]])) >= LEAST_DIGITS[kind]:
                added.append(span)
        i = j
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPANS_SQL = "array<struct<kind: string, start: bigint, end: bigint>>"


def _as_structs(spans: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], _SPANS)


def personal_data(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, base, spans) of every row: the patterns' spans, and all spans, in code points of the whole text.

    Null and empty texts have none; a null doc_id is kept as it is; repeated rows are answered each; an empty table
    gives an empty result; other columns are ignored.
    """
    docs = documents.select("doc_id", "text")
    field = field or fit_field(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(text, field) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _as_structs([f[0] for f in found]), _as_structs([f[1] for f in found])], ["doc_id", "base", "spans"])

    return docs.mapInArrow(run, f"doc_id long, base {_SPANS_SQL}, spans {_SPANS_SQL}")


def redact_text(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, overlapping ones as one, replaced by ``<KIND>``."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """``documents`` with all spans of ``text`` replaced by their kind; other columns and all rows stay."""
    field = field or fit_field(documents.select("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [redact_text(t, all_spans(t, field)[1]) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return documents.mapInArrow(run, documents.schema)
