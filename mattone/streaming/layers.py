"""One layer kept up to date from another as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mattone.sources.tables import insert_ignore


def stream_layer(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    key: str = "id",
    order: list[str | Column] | None = None,
) -> StreamingQuery:
    """Run the transform on each new part of the source and insert-ignore the result into the table.

    The checkpoint remembers what was read, in place of a full anti-join per poll.
    A micro-batch that runs again after a failure rewrites its own folders.  They are named by the
    stream and the epoch: another stream into the table, or this one with a new
    checkpoint, counts its epochs from 0 again and must not meet them.  All
    available input is read, then the query ends.  The transform runs once per micro-batch.
    """

    def sink(rows: DataFrame, epoch: int) -> None:
        stream = _stream_id(rows.sparkSession, checkpoint)
        insert_ignore(transform(rows), path, key, order, batch_id=f"{stream}-{epoch:012d}")

    return (
        source.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when its checkpoint began."""
    written = spark.read.text(f"{checkpoint.rstrip('/')}/metadata")
    return written.select(F.get_json_object("value", "$.id").alias("id")).where("id is not null").first().id
