"""Layer tables in Parquet: insert-ignore appends, whole replacements, reads.

A table is laid out by a hash of its key, then by batch: ``bucket=<n>/batch_id=<id>``.  A
batch reads the keys of the buckets it touches and no others.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattone.operators.joins import first_per_key, shuffled
from mattone.operators.validate import validate
from mattone.schemas import schema_of
from mattone.session import work_folder

# Part of a table's layout: the same for as long as the table lives.
BUCKETS = 32
# A task writes about so many bytes, and so many rows at most, of a bucket; a larger batch has several tasks and files per bucket.
# Stored texts may be packed a hundredfold, so their bytes alone say little about what a task sorts.
PIECE_BYTES = 1 << 27
PIECE_ROWS = 1 << 18

BUCKET = "bucket"
BATCH = "batch_id"


@dataclass(frozen=True)
class InsertCounts:
    """``rejected`` rows have no key: they could be told from no other row, and are not stored."""

    inserted: int
    skipped: int
    rejected: int = 0


def bucket_of(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def read_table(spark: SparkSession, path: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
    """A table written by ``insert_ignore``, or only some of its buckets; a missing one has no rows."""
    rows = laid_out(spark, path, schema)
    return (rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))).drop(BUCKET)


def laid_out(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table's rows with their bucket and batch."""
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.StringType())])
    try:
        rows = spark.read.schema(full).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], full)
    return rows


def read_layer_table(spark: SparkSession, path: str, layer: str, errors: str | None = None) -> DataFrame:
    """A layer's rows. With ``errors`` they are checked again as they are loaded: ``quarantine`` adds
    ``failed_rules``, ``fail`` ends the job at the first row that breaks one."""
    rows = read_table(spark, path, schema_of(layer)).drop(BATCH)
    return rows if errors is None else validate(rows, layer, errors)


def insert_ignore(
    batch: DataFrame,
    path: str,
    key: str = "id",
    order: list[str | Column] | None = None,
    batch_id: str | None = None,
    columns: list[str] | None = None,
) -> InsertCounts:
    """Append the batch's rows whose key the table lacks; the first row of a key wins, the rest is skipped.

    ``columns`` names those to store when the batch carries others only for the order.

    The batch is evaluated once, into a work folder; counting, comparing and writing
    only read that.  Each batch has folders of its own and replaces them as a whole.  Running a batch
    again under its ``batch_id`` compares with every other batch and writes the same rows,
    so a retry adds nothing twice.  One writer per table.
    """
    spark = batch.sparkSession
    staged = work_folder(spark, "staged")
    batch.write.parquet(staged)
    rows = spark.read.schema(batch.schema).parquet(staged)
    # At most BUCKETS numbers come to the driver; they prune the table's scan.
    total, rejected, touched = rows.agg(F.count("*"), F.count_if(F.col(key).isNull()), F.collect_set(F.when(F.col(key).isNotNull(), bucket_of(key)))).first()
    if total == rejected:
        return InsertCounts(0, 0, rejected)
    own = batch_id or new_batch_id()
    stored = rows.select(*(columns or batch.columns))
    known = read_table(spark, path, stored.schema, touched).where(F.col(BATCH) != own).select(key)
    new = first_per_key(rows.where(F.col(key).isNotNull()), key, order or []).join(shuffled(known), key, "left_anti").select(*stored.columns)
    write_batch(new, path, key, F.lit(own), max(pieces_of(rows), -(-total // (BUCKETS * PIECE_ROWS))))
    # Counted from what was written, not from the plan, which would now see its own rows.
    inserted = read_table(spark, path, stored.schema, touched).where(F.col(BATCH) == own).count()
    return InsertCounts(inserted, total - rejected - inserted, rejected)


def pieces_of(rows: DataFrame) -> int:
    """In how many tasks each bucket of these rows, read from files, is to be written."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return -(-size // (BUCKETS * PIECE_BYTES)) or 1


def write_batch(rows: DataFrame, path: str, key: str | list[str], batch: Column, pieces: int = 1, drop: list[str] | None = None) -> None:
    """Replace the folders of these buckets and this batch; each gets one file per piece, which a range of the key's hash makes up."""
    keys = [key] if isinstance(key, str) else key
    placed = rows.withColumns({BUCKET: bucket_of(*keys), BATCH: batch}).drop(*(drop or []))
    if pieces == 1:
        placed = placed.repartition(BUCKET)
    else:
        # Of the hash, what the bucket does not use (BUCKETS is 2^5).
        piece = F.pmod(F.shiftright(F.xxhash64(*keys), 5), F.lit(pieces))
        placed = placed.repartition(BUCKETS * pieces, BUCKET, piece)
    placed.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(BUCKET, BATCH).parquet(path)


def new_batch_id() -> str:
    """Unique, and later ones sort after earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str, out: str, buckets: list[int] | None = None) -> None:
    """Rewrite a table, or some of its buckets, with one row per key, the earliest batch's, as one batch.

    It ends the small files of many batches, and repairs a table that had two writers.
    """
    stored = read_table(spark, path, schema, buckets)
    write_batch(first_per_key(stored, key, [F.col(BATCH)]).drop(BATCH), out, key, F.lit("0"), pieces_of(stored))


# Below so many bytes a table is not worth a shuffle; above it, a task's share of rows from which texts or pages are made.
SPREAD_BYTES = 1 << 20


def spread(df: DataFrame, task_bytes: int | None = None) -> DataFrame:
    """``df``, dealt anew if its files give fewer partitions than the session has cores, or than ``task_bytes`` of its files a task ask for.

    A file of one row group is one task however many cores there are, and reading pages or texts costs far more than moving
    their rows.  A table in enough partitions stays as it is and is not shuffled.  Partitions of a file may also be empty, as those
    that begin no row group are, and small rows may grow to long texts: ``task_bytes`` bounds what one task reads however the files are cut.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    wanted = max(cores, -(-size // task_bytes) if task_bytes else 0)
    if size < SPREAD_BYTES or df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write a result as the whole content of a table and return that table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages (page_id, url, html)."""
    return spread(spark.read.parquet(path).select("page_id", "url", "html"))
