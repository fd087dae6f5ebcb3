"""Wavelet matrices against plain arrays, and shards against the tokenizer library."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from mattone.llm import wavelet
from mattone.session import work_folder
from test_edges import BPE, ROWS, SCHEMA


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 5000])
def test_matrix(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 300, n).astype(np.uint16)
    m = wavelet.Matrix.from_bytes(wavelet.Matrix.build(ids, 9).to_bytes())
    assert (m.sequence() == ids).all() and len(m.sequence()) == n
    for i in rng.integers(0, n, 20) if n else []:
        token = int(ids[i])
        assert m.access(int(i)) == token
        assert m.rank(token, int(i)) == (ids[:i] == token).sum()
        at = np.flatnonzero(ids == token)
        k = int(rng.integers(0, len(at)))
        assert m.select(token, k) == at[k]
    with pytest.raises(IndexError):
        m.select(299, n + 1)


def test_shards(spark, monkeypatch):
    """Starts, lengths and checksums equal those of the library, over several shards."""
    tokenizer = Tokenizer.from_file(BPE)
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(100_000 + i, r[1]) for i, r in enumerate(ROWS)] + [(200_000, "a  b \n c\n\n d   e's  "), (200_001, " lead\ttab \r\n x")], "doc_id long, text string")
    docs = base.union(odd)
    path = work_folder(spark, "shards")
    wavelet.write_shards(docs, BPE, path)
    shards = wavelet.read_shards(spark, path)
    got = {r.doc_id: r for r in wavelet.documents_of(shards).collect()}
    start, ids_of = 0, {}
    for doc, text in sorted(docs.collect()):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        ids_of[doc] = ids
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), doc
        start += len(ids)
    token = ids_of[0][3]
    assert {(r.token, r.n) for r in wavelet.count_tokens(shards, [token, 0]).collect()} == {(t, sum(x.count(t) for x in ids_of.values())) for t in (token, 0)}
    assert {(r.doc_id, r.position) for r in wavelet.occurrences(shards, token).collect()} == {(d, i) for d, x in ids_of.items() for i, t in enumerate(x) if t == token}


ODD = ["a", "b", "Z", "é", "×", "÷", "ж", "\u0482", "あ", "漢", "\u3000", "\u00a0", "\u0085", "\u2003", "\u2028", "\u202f", "\u205f", "\u1680", "\u180e", "\u200b"]
ODD += [" ", " ", " ", "\n", "\n", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x00", "'", "'s", "'re", ",", ".", "1", "23", "_", "<|endoftext|>", "🎉", "\u0301", "ʔ", "¼", "²", "٣"]


@pytest.mark.parametrize("form", ["as given", "with a prefix", "normalised", "of another pattern"])
def test_cut_texts(form):
    """Ids of units put together are those the library gives for whole texts."""
    with open(BPE, encoding="utf-8") as f:
        spec = json.load(f)
    if form == "with a prefix":
        spec["pre_tokenizer"]["add_prefix_space"] = True
    elif form == "normalised":
        spec["normalizer"] = {"type": "NFC"}
    elif form == "of another pattern":
        split = {"type": "Split", "pattern": {"Regex": r" ?[^\s\p{L}\p{N}]+[\r\n]*|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}|\s+(?!\S)|\s+"}, "behavior": "Isolated", "invert": False}
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [split, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
    definition = json.dumps(spec)
    encoder, library, rng = wavelet.Encoder(definition), Tokenizer.from_str(definition), random.Random(4)
    assert encoder.encode(pa.array([None, "", None], pa.string())) == [b""] * 3 and encoder.encode(pa.array([], pa.string())) == []
    for k in range(30):
        texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(0, 25))) for _ in range(100)]
        texts = [t.replace("<|endoftext|>", "") for t in texts] if k % 3 else texts
        for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
            assert np.frombuffer(ids, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_words_are_encoded_once_whatever_follows():
    """The library is asked for a word and a mark, not for each of their combinations."""
    with open(BPE, encoding="utf-8") as f:
        encoder = wavelet.Encoder(f.read())
    words, marks = [f"w{c}rd" for c in "abcdefghij"], [",", ".", ";", ":", "!", "?", ".\n", ",\n"]
    encoder.encode(pa.array([" ".join(w + m for w in words for m in marks)]))
    # Words after a space, after a line break and at the start of the text; marks and line breaks.
    assert len(encoder.kept) <= 3 * len(words) + len(marks)
