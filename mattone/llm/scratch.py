"""Tables written between two steps of an operator, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.session import work_folder

# A side is broadcast only if it was counted and holds at most this many rows of a few numbers.
BROADCAST_ROWS = 2_000_000
# Garbage of the driver is collected after a step that leaves more than this share of its heap in use.
HEAP_SHARE = 1 / 3
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, stored under ``spark.checkpoint.dir``: its lineage is cut, and it is computed once.

    Plans and broadcasts of the steps of a long operator would else fill the driver's heap up to its limit, whatever is still in use.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() - heap.freeMemory() > HEAP_SHARE * heap.maxMemory():
        spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, purpose: str) -> DataFrame:
    """As ``written``, for a step with much to shuffle: what it shuffled and broadcast is dropped once it has ended.

    Spark drops a query's shuffle files at its end if told so; else, as broadcasts, only after a collection of the driver's garbage that finds
    them unused, which it asks for every half hour and which may still find the query that has just ended in use.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        table = written(df, purpose)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)
    df.sparkSession._jvm.System.gc()
    return table


def small_side(df: DataFrame) -> DataFrame:
    """``df``, a written table, marked for broadcast if its counted rows are few; else Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def fold(column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: the fold a document belongs to. A null id has fold 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")
