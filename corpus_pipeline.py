"""From raw documents to token ids: five stages, each written and read again as the next one's input.

A stage takes the columns of documents, other columns are dropped; null texts are empty ones.  All stages but the last return these columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mattone.llm import decontamination, near_duplicates, personal_data, pieces, quality
from mattone.llm.queries import PIECES
from mattone.llm.scratch import fold, small_side, written, written_alone

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the doc_ids of ``gone``; rows without a doc_id stay."""
    return docs.join(small_side(written_alone(gone.select("doc_id").distinct(), "gone")), "doc_id", "left_anti").select(COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold stay; without any label nothing can be rejected and all stay."""
    docs = docs.select(COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    measured = written_alone(quality.measure(docs), "statistics")
    return quality.accepted(docs, quality.fit_quality(measured, labels, fold(F.col("doc_id"), 4) == 2))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more the document of the smallest doc_id stays.

    Rows without a doc_id all stay, and so do repeated rows of the doc_id that stays.
    """
    return _without(docs.select(COLUMNS), near_duplicates.near_duplicates(docs, percent=80).where("not kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return _without(docs.select(COLUMNS), decontamination.find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, personal data replaced by its kind; n_chars counts what is left."""
    return personal_data.redact(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of every document."""
    return pieces.encode(docs, PIECES)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_personal_data", redact_personal_data),
    ("encode", encode),
]

# Fitted scores, messages between tokens and shortest paths have no statement in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_alone(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
