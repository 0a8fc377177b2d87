"""Streaming sinks that can be restarted: checkpointed, and replayable per batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import if_present
from tidemark.streaming.batches import BATCH, BatchWriter, batch_folders, read_batches

ATTEMPT = "attempt_id"
_ATTEMPTS = f"{ATTEMPT} STRING"
#: Marks of published results that are kept.
_MARKS = 8


def for_each_batch(
    stream: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    *,
    mode: str = "append",
    continuous: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch to ``write(batch, batch_id)``.

    After a failure the last batch is handed over again with its id: ``write`` must then have the
    same effect as before. Stops when the present input is used up, unless ``continuous``; the
    caller decides whether to block with ``awaitTermination``.
    """
    writer = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    return (writer if continuous else writer.trigger(availableNow=True)).start()


def latest_result(path: str) -> BatchWriter:
    """Keep the full result of a complete-mode stream, and the one before it.

    Two folders take turns. A result is written to the one that is not published and then published
    by a mark, so ``read_latest`` never meets an unfinished folder; marks take turns as well.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = _published(spark, path)
        turn, slot = (0, 0) if last is None else (last["turn"] + 1, 1 - last["slot"])
        batch.write.mode("overwrite").parquet(f"{path}/slot={slot}")
        mark = spark.range(1).select(F.lit(turn).cast("long").alias("turn"), F.lit(slot).alias("slot"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/published/mark={turn % _MARKS}")

    return write


def _published(spark: SparkSession, path: str):
    """The latest mark of ``latest_result``, or ``None`` where there is none yet."""
    marks = if_present(
        spark.read.schema("turn BIGINT, slot INT").option("ignoreMissingFiles", "true"),
        f"{path}/published",
    )
    return None if marks is None else marks.agg(F.max_by(F.struct("turn", "slot"), "turn")).first()[0]


def warehouse_append(sink_format: str, attempts: str, **options: str) -> BatchWriter:
    """Append each batch, marked with ``batch_id`` and an ``attempt_id``, through a connector.

    A connector without transactions may keep what a died attempt has written. An attempt that came
    to its end is noted in the folder ``attempts``, and a batch noted there is not written again;
    ``committed`` leaves out the rows of all other attempts. The notes are a log of batches, which
    ``fold_batches`` keeps short.
    """
    note = batch_folders(attempts)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, attempt = batch.sparkSession, uuid.uuid4().hex
        noted = read_batches(spark, attempts, _ATTEMPTS, with_ids=True)
        if not noted.filter(F.col(BATCH) == batch_id).isEmpty():
            return
        marks = {BATCH: F.lit(batch_id).cast("long"), ATTEMPT: F.lit(attempt)}
        batch.withColumns(marks).write.format(sink_format).mode("append").options(**options).save()
        note(spark.range(1).select(F.lit(attempt).alias(ATTEMPT)), batch_id)

    return write


def committed(rows: DataFrame, attempts: str) -> DataFrame:
    """The rows, read back from the warehouse, of attempts that came to their end."""
    noted = read_batches(rows.sparkSession, attempts, _ATTEMPTS, with_ids=True)
    return rows.join(noted, [BATCH, ATTEMPT], "left_semi")


def read_latest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The latest full result of a complete-mode stream written by ``latest_result``."""
    last = _published(spark, path)
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/slot={last['slot']}")


def to_files(
    stream: DataFrame, path: str, checkpoint: str, *, continuous: bool = False
) -> StreamingQuery:
    """Append to a folder of Parquet files; its log makes every row appear exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return (writer if continuous else writer.trigger(availableNow=True)).start()
