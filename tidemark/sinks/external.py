"""Sinks outside the lake: JDBC databases and warehouse connectors."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.scd2 import Dimension, HistoryError, Quarantine, scd2_initial, scd2_merge
from tidemark.session import if_present, scratch_run
from tidemark.sources.external import JdbcDatabase


def write_jdbc(
    df: DataFrame,
    database: JdbcDatabase,
    table: str,
    *,
    mode: str = "errorifexists",
    connections: int = 8,
    batch_rows: int = 10_000,
) -> None:
    """Write a frame to a database table over at most ``connections`` connections."""
    (
        df.write.format("jdbc")
        .mode(mode)
        .options(**database.table_options(table))
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .save()
    )


def write_warehouse(
    df: DataFrame, sink_format: str, *, mode: str = "overwrite", **options: str
) -> None:
    """Write with any connector: staged through a bucket or directly, as its options say."""
    df.write.format(sink_format).mode(mode).options(**options).save()


def merge_external(
    source: DataFrame,
    history: Callable[[], DataFrame | None],
    dim: Dimension,
    *writes: Callable[[DataFrame], None],
    record: str,
    as_of: datetime | Column | None = None,
    quarantine: Quarantine | None = None,
) -> None:
    """Write the next history of a dimension to a table outside the lake, and to its copies.

    ``history`` reads the table, or returns ``None`` for the first load. An external overwrite
    empties the table that the merge is still reading, and may die half-way, so the result is first
    written to the folder ``record`` and noted there; then each of ``writes`` is noted as it ends. A
    call that finds an unfinished merge there first brings that to its end: an overwrite that died is
    done again from the noted result. Only then is ``history`` called, so it never reads a table
    written in part. Source rows without a key are an error, or go to ``quarantine``.
    """
    spark = source.sparkSession
    finish_external(spark, record, *writes)
    with scratch_run(spark):
        held = history()
        if held is None:
            result = scd2_initial(source, dim, as_of=as_of, quarantine=quarantine)
        else:
            result = scd2_merge(held, source, dim, as_of=as_of, quarantine=quarantine)
        result.write.mode("overwrite").parquet(f"{record}/result")  # of the last merge, which is finished
    _note(spark, record, 0)
    finish_external(spark, record, *writes)


def finish_external(spark: SparkSession, record: str, *writes: Callable[[DataFrame], None]) -> bool:
    """Do what an unfinished merge has left to write; whether there was one.

    The writes are to be those of the merge, in its order. Each replaces its table, so one that
    died can be repeated.
    """
    last = _last_note(spark, record)
    if last is None or last["done"] >= len(writes):
        return False
    result = spark.read.parquet(f"{record}/result")
    for number in range(last["done"], len(writes)):
        writes[number](result)
        _note(spark, record, number + 1)
    return True


def give_up_external(spark: SparkSession, record: str) -> None:
    """Roll an unfinished merge back: allowed as long as no table was written whole or begun.

    ``HistoryError`` where a write has ended; whether the first write had begun only the caller can tell.
    """
    last = _last_note(spark, record)
    if last is not None and last["done"] > 0:
        raise HistoryError(f"{record}: {last['done']} tables hold the merge already; finish it")
    if last is not None:
        _note(spark, record, _GIVEN_UP)


#: Notes of the record: how many writes of a merge have ended; a large number where it was given up.
_NOTES, _GIVEN_UP = "number BIGINT, done INT", 2**31 - 1
#: Notes that are kept.
_KEPT = 8


def _last_note(spark: SparkSession, record: str) -> Row | None:
    notes = if_present(spark.read.schema(_NOTES).option("ignoreMissingFiles", "true"), f"{record}/notes")
    return None if notes is None else notes.orderBy(F.desc("number")).first()


def _note(spark: SparkSession, record: str, done: int) -> None:
    last = _last_note(spark, record)
    number = 0 if last is None else last["number"] + 1
    note = spark.createDataFrame([(number, done)], _NOTES).coalesce(1)
    note.write.mode("overwrite").parquet(f"{record}/notes/of={number % _KEPT}")
