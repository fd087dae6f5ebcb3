"""Shortest paths against the piece library."""

import random

import pytest
import sentencepiece

from mattone.llm import pieces
from test_edges import LONG, MODEL, ROWS


@pytest.fixture(scope="module")
def machine():
    return pieces.Machine.load(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_documents(spark, machine, library):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [*texts, LONG]:
        ids = list(machine.encode(text))
        assert ids == library.encode(text)
        assert machine.decode(machine.encode(text)) == text


@pytest.mark.parametrize("text", ["", " ", "   ", "a", " a", "a ", "  two   runs  ", "\n\n", "x\ny", "aaaaaaaaaaaa", "====----====", "<s>", "<0x41>", "é漢🎉\x00\x7f", "▁", "a▁b", "1234567890 000"])
def test_odd_texts(machine, library, text):
    assert list(machine.encode(text)) == library.encode(text)
    assert machine.decode(machine.encode(text)) == text.replace("▁", " ")


def test_random_texts(machine, library):
    rng = random.Random(6)
    for alphabet in ("ab ", "thein g", "=-_ \n", "éàßabc", "0123. "):
        for _ in range(60):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60)))
            assert list(machine.encode(text)) == library.encode(text), text


def test_encode_and_decode(spark, machine):
    docs = spark.createDataFrame([(i, r[1]) for i, r in enumerate(ROWS)], "doc_id long, text string")
    encoded = pieces.encode(docs, MODEL)
    back = {r.doc_id: r.text for r in pieces.decode(encoded, MODEL).collect()}
    assert back == {i: (r[1] or "").replace("▁", " ") for i, r in enumerate(ROWS)}
