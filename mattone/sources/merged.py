"""Tables whose rows are replaced by key: a base and newer batches by key bucket, merged when they are read.

The layout is that of ``sources/tables``: ``bucket=<n>/batch_id=<id>``.  An upsert writes its rows into folders of its own in the buckets that
they fall into and reads nothing of the table.  ``fold`` makes one base of a bucket's base and batches; it touches the buckets that have batches
and no others.  A base is named ``~<last batch in it>``; readers pass over everything that the newest base of a bucket holds, so a
fold that is cut short at any point, or run again, changes no answer.  Batch ids must sort by age, as those that are made here do.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattone.operators.joins import row_digest
from mattone.session import work_folder
from mattone.sources.tables import BATCH, BUCKET, laid_out, new_batch_id, pieces_of, write_batch

BASE = "~"
_ID = re.compile(r"[0-9A-Za-z_-]+")


def upsert(batch: DataFrame, path: str, keys: list[str], order: list[str | Column] | None = None, batch_id: str | None = None, columns: list[str] | None = None) -> str:
    """Write the batch's last row of each key by ``order``, which replaces older rows of that key; the batch's id is returned.

    ``columns`` names those to store if others serve the order alone.  Rows with a null in a key are not stored; equal positions fall to a
    digest of the row.  Run again under its ``batch_id`` with the same rows, a batch replaces itself.  An empty batch writes nothing.
    """
    own = batch_id or new_batch_id()
    if not _ID.fullmatch(own):
        raise ValueError("a batch id is made of letters, digits, _ and -")
    spark, stored = batch.sparkSession, columns or batch.columns
    rest = [c for c in stored if c not in keys]
    whole = batch.where(F.forall(F.array(*[F.col(k).isNotNull() for k in keys]), lambda x: x))
    latest = whole.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*(order or []), row_digest(batch))).alias("_last"))
    staged = work_folder(spark, "upsert")
    latest.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in stored]).write.parquet(staged)
    rows = spark.read.schema(batch.select(*stored).schema).parquet(staged)
    write_batch(rows, path, keys, F.lit(own), pieces_of(rows))
    return own


def read_merged(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: list[int] | None = None) -> DataFrame:
    """One row per key, its newest batch's; of all buckets or some.  A missing table has no rows.

    The base is not grouped again: it loses the keys of the newer batches, which alone are reduced.
    Few newer rows are broadcast by Catalyst, and the base is then read without a shuffle.
    """
    return _merged(laid_out(spark, path, schema), schema, keys, buckets).drop(BUCKET)


def fold(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> list[int]:
    """Make one base of each bucket that has newer batches, and remove what it holds; returns those buckets."""
    rows = laid_out(spark, path, schema)
    _, newer = _live(rows)
    # A row for each bucket at most.
    last = {r[BUCKET]: r.last for r in newer.groupBy(BUCKET).agg(F.max(BATCH).alias("last")).collect()}
    if not last:
        return []
    base = F.concat(F.lit(BASE), _by_bucket(last))
    write_batch(_merged(rows, schema, keys, list(last)).withColumn("_base", base), path, keys, F.col("_base"), pieces_of(rows), drop=["_base"])
    for bucket, mark in last.items():
        _remove_older(spark, f"{path}/{BUCKET}={bucket}", mark)
    return sorted(last)


def _merged(rows: DataFrame, schema: T.StructType, keys: list[str], buckets: list[int] | None) -> DataFrame:
    """The schema's columns and the bucket."""
    base, newer = _live(rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets)))
    rest = [c for c in schema.names if c not in keys]
    # A key has one bucket; it is a key here so that it stays a column of the layout.
    latest = newer.groupBy(*keys, BUCKET).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("_last"))
    latest = latest.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in schema.names], BUCKET)
    kept = base.join(newer.select(*keys), keys, "left_anti")
    return kept.select(*schema.names, BUCKET).unionByName(latest)


def _live(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of each bucket's newest base, rows of the batches after it); conditions on the layout, so that other folders are not read."""
    is_base, held = F.col(BATCH).startswith(BASE), F.expr(f"substring({BATCH}, 2)")
    marks = {r[BUCKET]: r.mark for r in rows.where(is_base).groupBy(BUCKET).agg(F.max(held).alias("mark")).collect()}
    if not marks:
        return rows.where(F.lit(False)), rows.where(~is_base)
    mark = _by_bucket(marks)
    return rows.where(is_base & (held == mark)), rows.where(~is_base & (mark.isNull() | (F.col(BATCH) > mark)))


def _by_bucket(values: dict[int, str]) -> Column:
    pairs = [F.lit(x) for bucket, value in sorted(values.items()) for x in (bucket, value)]
    return F.try_element_at(F.create_map(*pairs), F.col(BUCKET))


def _remove_older(spark: SparkSession, bucket: str, mark: str) -> None:
    """The bucket's folders whose rows the base of ``mark`` holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(bucket)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name = status.getPath().getName().removeprefix(f"{BATCH}=")
        if name.removeprefix(BASE) < mark or name == mark:
            files.delete(status.getPath(), True)
