"""Layer tables that Spark knows as bucketed by their key, for joins of layers without a shuffle.

Two tables with the same number of buckets hold equal keys in buckets of equal number.  Spark then joins them, as ``joins.pending``
does, bucket by bucket where they lie.  The number is chosen when the table is created, from the size that it shall reach, and is part of its
folder's name: a later session that opens the table gets that number.  Batches are partitions, each replaced as a whole when it runs again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattone.operators.joins import first_per_key
from mattone.session import work_folder
from mattone.sources.tables import BATCH, InsertCounts, new_batch_id

_FOLDER = re.compile(r"of-([0-9]+)")


@dataclass(frozen=True)
class BucketedTable:
    """A catalog entry ``name`` over Parquet files in ``buckets`` buckets by ``key``, partitioned by batch."""

    spark: SparkSession
    name: str
    key: str
    buckets: int

    def read(self) -> DataFrame:
        """The rows, without the batch they came by."""
        return self.spark.table(self.name).drop(BATCH)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, key: str = "id", buckets: int = 32) -> BucketedTable:
    """Create the table, or open the one at ``path``, whose own number of buckets then holds.

    ``name`` is entered in the session's catalog; an entry of that name over another folder is an error.
    """
    before = _stored_buckets(spark, path)
    number = before or buckets
    if number < 1:
        raise ValueError("a table has one bucket or more")
    place = f"{path.rstrip('/')}/of-{number}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{BATCH}` string) USING parquet OPTIONS ('partitionOverwriteMode' = 'dynamic') "
        f"PARTITIONED BY (`{BATCH}`) CLUSTERED BY (`{key}`) INTO {number} BUCKETS LOCATION '{place}'"
    )
    stored = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if not stored["Location"].rstrip("/").endswith(place.split(":", 1)[-1].lstrip("/")):
        raise ValueError(f"{name} is a table in {stored['Location']}")
    if before:
        # Batches that the catalog of this session does not know yet.
        spark.catalog.recoverPartitions(name)
    return BucketedTable(spark, name, key, number)


def insert_ignore_bucketed(
    batch: DataFrame,
    table: BucketedTable,
    order: list[str | Column] | None = None,
    batch_id: str | None = None,
) -> InsertCounts:
    """``tables.insert_ignore`` for a bucketed table: the first row of a new key is stored, stored keys stay as they are.

    Rows without a key are rejected.  The table's side of the comparison is read by buckets and not shuffled; what is new is dealt
    by bucket, one task for each, so the number of buckets is that of the writing tasks.  A batch that runs again under its ``batch_id``
    is compared with the other batches and replaces its own rows, with none if it has none.  One writer per table.
    """
    spark, key = table.spark, table.key
    staged = work_folder(spark, "staged")
    batch.write.parquet(staged)
    rows = spark.read.schema(batch.schema).parquet(staged)
    total, rejected = rows.agg(F.count("*"), F.count_if(F.col(key).isNull())).first()
    own = batch_id or new_batch_id()
    stored = [c for c in spark.table(table.name).columns if c != BATCH]
    known = spark.table(table.name).where(F.col(BATCH) != own).select(key)
    new = first_per_key(rows.where(F.col(key).isNotNull()), key, order or []).join(known, key, "left_anti")
    # A table that is read cannot be overwritten in the same statement; the new rows are written once beside it.
    fresh = work_folder(spark, "fresh")
    new.select(*stored).write.parquet(fresh)
    placed = spark.read.schema(new.select(*stored).schema).parquet(fresh)
    inserted = placed.count()
    dealt = placed.withColumn(BATCH, F.lit(own)).repartition(table.buckets, key)
    if inserted:
        dealt.write.insertInto(table.name, overwrite=True)
    spark.catalog.refreshTable(table.name)
    return InsertCounts(inserted, total - rejected - inserted, rejected)


def _stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The number in the name of the table's folder, if there is one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    found = [_FOLDER.fullmatch(s.getPath().getName()) for s in files.listStatus(folder)]
    return next((int(m[1]) for m in found if m), None)
