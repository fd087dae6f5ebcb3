"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

from mattone.llm import decontamination, languages, mixing, near_duplicates, periodic_runs, personal_data, pieces, quality, rules, substrings, vector_codes, wavelet, wrappers
from mattone.llm.scratch import fold
from mattone.session import work_folder
import corpus_pipeline

LONG = " ".join(f"word{i % 977} of the long text" for i in range(20_000))
ROWS = [
    (1, "the same short text again and again", "en", "a", None, 0.5, "x"),
    (1, "the same short text again and again", "en", "a", 35, 0.5, "x"),
    (2, None, None, None, None, None, None),
    (3, "", "en", "a", 0, 0.1, "x"),
    (4, " \n\t ", "en", None, 4, 0.1, "x"),
    (5, LONG, "en", "b", len(LONG), 0.1, "x"),
    (None, "a text without an id", "en", "b", 20, 0.1, "x"),
    (None, None, None, "b", None, 0.1, "x"),
    (6, "Ünïcödé ▁ \x00   漢字 🎉 <|endoftext|> a@b.co +1 (555) 010-9999", "de", "b", 60, 0.1, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, sig string"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BPE = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, 1, None), (5, None, 0), (None, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "the same short text again and again"), (2, None), (3, ""), (None, "a text without an id"), (4, "漢字")]
    return spark.createDataFrame(rows, "item_id long, text string")


def _shards(docs):
    path = work_folder(docs.sparkSession, "edge-shards")
    wavelet.write_shards(docs, BPE, path)
    return wavelet.documents_of(wavelet.read_shards(docs.sparkSession, path))


OPERATORS = {
    "wavelet": lambda d, l, b: _shards(d),
    "mixing": lambda d, l, b: mixing.text_scores(d, fold(F.col("doc_id"), 5) != 1),
    "rules": lambda d, l, b: rules.judge(d),
    "quality": lambda d, l, b: quality.quality_scores(d, l, fold(F.col("doc_id"), 4) == 2),
    "pieces": lambda d, l, b: pieces.round_trip(d, MODEL),
    "languages": lambda d, l, b: languages.language_mixtures(d, languages.fit_languages(d)),
    "personal_data": lambda d, l, b: personal_data.personal_data(d),
    "near_duplicates": lambda d, l, b: near_duplicates.near_duplicates(d),
    "periodic_runs": lambda d, l, b: periodic_runs.find_runs(d),
    "substrings": lambda d, l, b: substrings.remove_repeated(d),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_one_answer_per_row(docs, labels, benchmark, name):
    got = sorted([r.doc_id for r in OPERATORS[name](docs, labels, benchmark).collect()], key=str)
    assert got == sorted([r[0] for r in ROWS], key=str)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(docs, labels, benchmark, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), benchmark).collect() == []


def test_repeated_rows_have_equal_answers(docs, labels, benchmark):
    for name in ("mixing", "rules", "quality", "pieces", "languages", "personal_data", "near_duplicates", "periodic_runs", "substrings"):
        rows = OPERATORS[name](docs, labels, benchmark).where("doc_id = 1").collect()
        assert len(rows) == 2 and rows[0] == rows[1], name


def test_near_duplicates_without_words_or_id(docs):
    rows = {r.doc_id: r for r in near_duplicates.near_duplicates(docs).where("doc_id is not null").collect()}
    assert [rows[i].n_shingles for i in (2, 3, 4)] == [0, 0, 0]
    assert all(rows[i].component_id == i and rows[i].kept for i in (1, 2, 3, 4, 5, 6))
    lost = near_duplicates.near_duplicates(docs).where("doc_id is null").collect()
    assert all(r.component_id is None and r.kept for r in lost)


def test_decontamination(docs, benchmark):
    got = {(r.doc_id, r.item_id, r.similarity) for r in decontamination.find_items(docs, benchmark).collect()}
    assert got == {(1, 1, 1.0), (6, 4, 1.0)}
    assert decontamination.find_items(docs.limit(0), benchmark).collect() == []
    assert decontamination.find_items(docs, benchmark.limit(0)).collect() == []


def test_pages(spark):
    rows = [(1, None, None, 1), (2, "http://h/a", "", 1), (3, "http://h/b", "<p>x", 1), (3, "http://h/b", "<p>x", 1), (None, "http://h/c", "<" * 50 + "a" * 50, 1), (4, "http://h/d", "<div>" * 5000 + "deep", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted([(r.page_id or 0, r.text) for r in wrappers.main_texts(pages).collect()])
    assert [t for p, t in got if p == 1] == [""] and [t for p, t in got if p == 2] == [""]
    assert [t for p, t in got if p == 3] == ["x", "x"] and [t for p, t in got if p == 4] == ["deep"]
    assert wrappers.main_texts(pages.limit(0)).collect() == []


def test_pipeline_stages(spark, docs, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            assert name == "encode" or out.columns == corpus_pipeline.COLUMNS
            assert out.count() <= rows.count()


def test_vectors(spark):
    odd = [None, [1.0, None, 0.0, 0.0, 0.0], [1.0, float("nan"), 0.0, 0.0, 0.0], [1.0, float("inf"), 0.0, 0.0, 0.0]]
    good = [(1, [1.0, 2.0, 3.0, 4.0, 5.0], 7), (1, [1.0, 2.0, 3.0, 4.0, 5.0], 7), (2, [], None), (3, [3e38, -3e38], None), (None, [0.5], 7)]
    rows = [(i, v, 0) for i, v in enumerate(odd)] + good
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, error int")
    codes, books = vector_codes.vector_codes(vectors)
    got = sorted((str(r.vec_id), r.code.hex(), r.error, r.label_error) for r in vector_codes.with_label_error(codes).collect())
    # Entries begin as the vectors themselves, by vec_id; equal parts fall to the lowest index.
    assert got == [("1", "00000000", 0, 0), ("1", "00000000", 0, 0), ("2", "02020200", 0, 0), ("3", "03020200", 0, 0), ("None", "04020200", 0, 0)]
    assert [len(e) for e in books.entries] == [5] * 4
    none, empty = vector_codes.vector_codes(vectors.limit(0))
    assert none.collect() == [] and vector_codes.with_label_error(none).collect() == [] and empty.entries == []
