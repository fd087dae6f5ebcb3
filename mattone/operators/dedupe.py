"""Duplicates by content and by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.operators.joins import first_per_key, row_digest


def content_digest(columns: list[str]) -> Column:
    """MD5 of the columns as one JSON text; null and missing are the same."""
    return F.md5(F.to_json(F.struct(*columns)))


def dedupe_by_content(df: DataFrame, id_cols: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per distinct content, the content being every column but the ids.

    Copies are dropped inside each task first, so a text copied across a third of
    the table reaches the shuffle once per task.
    """
    content = [c for c in df.columns if c not in id_cols]
    digested = df.withColumn("_digest", content_digest(content))
    return first_per_key(digested, "_digest", [F.col(c) for c in (order or id_cols)]).drop("_digest")


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[str], key: str = "key") -> DataFrame:
    """One row per key: the keys as a nested struct, the other fields of the key's first row."""
    rest = [c for c in df.columns if c not in keys]
    firsts = df.groupBy(F.struct(*keys).alias(key)).agg(
        F.min_by(F.struct(*rest), F.struct(*order, row_digest(df))).alias("_first")
    )
    return firsts.select(key, "_first.*")
