"""Document-style questions to a table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def count_all(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def count_where(df: DataFrame, field: str, value: Any) -> DataFrame:
    return count_all(find_eq(df, field, value))


def count_questions(df: DataFrame, questions: dict[str, Column]) -> DataFrame:
    """(question, n) for each named condition, all counted in one pass."""
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in questions.items()])
    return counts.select(F.explode(F.create_map(*[c for name in questions for c in (F.lit(name), F.col(f"`{name}`"))])).alias("question", "n"))


def find_eq(df: DataFrame, field: str, value: Any) -> DataFrame:
    """Rows whose field, nested ones by dotted name, equals the value."""
    return df.where(F.col(field) == F.lit(value))


def find_one(df: DataFrame, field: str, value: Any, order: list[str]) -> DataFrame:
    """The first such row by ``order``; empty when there is none."""
    return find_eq(df, field, value).orderBy(*order).limit(1)


def find_by_key(df: DataFrame, key: str, value: Any) -> DataFrame:
    """Rows with the key.  A text is never equal to a number: convert it with ``as_key`` first."""
    is_text = isinstance(df.schema[key].dataType, T.StringType)
    if isinstance(value, str) != is_text:
        return df.where(F.lit(False))
    return find_eq(df, key, value)


def find_by_key_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with the key given as text; a text that is no such key finds nothing."""
    return df.where(F.col(key) == F.lit(text).try_cast(df.schema[key].dataType))


def find_range_sorted(df: DataFrame, field: str, below: Any, sort: list[str]) -> DataFrame:
    """Rows with ``field`` below the bound, sorted ascending, missing values first.

    End ``sort`` with a unique column: the range sort can then split rows that share
    the leading value over several tasks.
    """
    bound = F.lit(below).cast(df.schema[field].dataType)
    return df.where(F.col(field) < bound).orderBy(*[F.col(c).asc_nulls_first() for c in sort])


def head(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def to_sparse_json(df: DataFrame, out: str = "json") -> DataFrame:
    """Each row as JSON text without its null fields."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))


def union_sparse(*tables: DataFrame) -> DataFrame:
    """Rows of tables with different columns in one table, missing ones null."""
    first, *others = tables
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
