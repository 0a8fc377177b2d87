"""Managed tables: insert, replace, copy, and the table form of the type-2 merge."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.scd2 import (
    ACTION,
    DELETE,
    INSERT,
    UPDATE,
    Dimension,
    HistoryError,
    Quarantine,
    find_changes,
    history_ends,
    next_versions,
    refuse_past,
    scd2_initial,
    split_history,
)
from tidemark.session import scratch_run, settings, stage

#: The merge that closed a row; ``open`` while it is open, ``before`` if closed before the first merge.
CLOSED_IN = "closed_in"
#: The bucket of an open row's key; closed rows are never read by key and have none.
KEY_BUCKET, CLOSED = "key_bucket", -1
BUCKETS = 32
_DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
#: A task that writes no more buckets than this keeps a file open for each and does not sort its rows.
_OPEN_WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "64"}
_PARTITIONS = ("is_current", CLOSED_IN, KEY_BUCKET)
#: Table properties: the last merge, the buckets, what it left behind, and a merge that is not applied yet.
_STATE, _PENDING = "tidemark.history.", "tidemark.pending."

log = logging.getLogger(__name__)


def insert_into(spark: SparkSession, table: str, query: str) -> None:
    """Append the result of a SQL query. Cast in the query: text is not stored as a date."""
    spark.sql(f"INSERT INTO {table} {query}")


def insert_overwrite(spark: SparkSession, table: str, query: str) -> None:
    """Replace the rows of a table by the result of a query that does not read this table."""
    spark.sql(f"INSERT OVERWRITE {table} {query}")


def save_table(
    df: DataFrame,
    table: str,
    *,
    mode: str = "errorifexists",
    buckets: tuple[int, str] | None = None,
    **options: str,
) -> None:
    """Save as a managed table, optionally in so many buckets of a column.

    Tables in equal buckets of a key are joined and summed by that key without a shuffle, which
    pays for orders and items that many reports read.
    """
    if buckets is not None:
        count, column = buckets
        df = df.repartition(count, column)  # one file per bucket
    writer = df.write.mode(mode).options(**options)
    if buckets is not None:
        writer = writer.bucketBy(count, column).sortBy(column)
    writer.saveAsTable(table)


def replace_rows(df: DataFrame, table: str) -> None:
    """Replace the rows of a table by a frame that may be computed from that very table.

    The frame is staged first: Spark refuses to overwrite what it is reading.
    """
    columns = df.sparkSession.table(table).columns
    _same_columns(df, columns, table)
    with scratch_run(df.sparkSession):
        stage(df.select(columns), "replacement").write.insertInto(table, overwrite=True)


def _same_columns(df: DataFrame, columns: list[str], table: str) -> None:
    """Rows go into a table by column name; a column that only one side has is an error."""
    if set(df.columns) != set(columns):
        odd = sorted(set(df.columns) ^ set(columns))
        raise ValueError(f"{table} and the rows for it differ in the columns {odd}")


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Make ``target`` hold the rows of ``source``."""
    spark.table(source).write.mode("overwrite").saveAsTable(target)


def save_history(
    history: DataFrame, table: str, dim: Dimension, *, buckets: int = BUCKETS
) -> None:
    """Save a history as a table in the layout that ``merge_table`` works on.

    ``buckets`` is the number of parts of the open rows, fixed for the life of the table: a merge
    rewrites whole buckets, so the more there are, the less it rewrites beside what has changed.
    """
    if buckets < 1:
        raise ValueError("a history needs at least one bucket")
    closed_in = F.when(F.col("is_current"), F.lit("open")).otherwise(F.lit("before"))
    bucket = F.when(F.col("is_current"), bucket_of(F.col(dim.key), buckets)).otherwise(F.lit(CLOSED))
    laid_out = history.withColumns({CLOSED_IN: closed_in, KEY_BUCKET: bucket})
    # each bucket in files of a good size, whatever the number of tasks
    laid_out.hint("rebalance", *_PARTITIONS).write.partitionBy(*_PARTITIONS).saveAsTable(table)
    _set(history.sparkSession, table, _STATE, {"merge": uuid.uuid4().hex, "buckets": str(buckets)})


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key, by a hash of its value; the same for ever."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def merge_table(
    source: DataFrame,
    table: str,
    dim: Dimension,
    *,
    as_of: datetime | None = None,
    synced: str | None = None,
    quarantine: Quarantine | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Bring a history table up to date with the source, or create it on the first call.

    The table is partitioned by ``is_current, closed_in, key_bucket``; times are plain columns. A
    merge compares keys and tracked columns of all open rows, whatever their ``expiration_date``.
    Then it reads and replaces the buckets only that hold a changed key, and adds one partition of
    the rows that it closes; all other files are neither read as whole rows nor written. Without
    changes nothing is written. ``as_of`` must not lie before the last change.

    The result is staged as a table beside the history, named by its properties until it is
    applied; a merge that died in between is completed by the next call. The partitions of the
    staged table are the list of touched buckets. ``synced`` names a second table that is kept
    equal to the history: by the same partitions, or by a full copy where it is not at the
    history's previous merge. Source rows without a key are an error, or go to ``quarantine``.
    ``buckets`` counts on the first call only.
    """
    spark = source.sparkSession
    as_of = datetime.now(timezone.utc) if as_of is None else as_of
    with scratch_run(spark):
        if not spark.catalog.tableExists(table):
            first = scd2_initial(source, dim, as_of=as_of, quarantine=quarantine)
            save_history(first, table, dim, buckets=buckets)
        else:
            finish_merge(spark, table)
            _stage_merge(source, table, dim, as_of, synced, quarantine)
            finish_merge(spark, table)
    if synced is not None:
        _catch_up(spark, table, synced)


def _stage_merge(
    source: DataFrame,
    table: str,
    dim: Dimension,
    as_of: datetime,
    synced: str | None,
    quarantine: Quarantine | None,
) -> None:
    """Write down what a merge will put into the table, and point to it."""
    spark = source.sparkSession
    history, state = spark.table(table), _get(spark, table, _STATE)
    if not {CLOSED_IN, KEY_BUCKET} <= set(history.columns) or "buckets" not in state:
        raise HistoryError(f"{table} has another layout: lay it out with save_history")
    columns = [*dim.history_columns(source.columns), CLOSED_IN, KEY_BUCKET]
    _same_columns(history, columns, f"{table} (before the merge)")
    open_rows, _ = split_history(history.drop(CLOSED_IN))
    # what the last merge left behind saves a scan of the closed rows
    known = "highest" in state
    highest, latest, now = history_ends(open_rows if known else history, dim, as_of)
    if known:
        highest, latest = max(highest, int(state["highest"])), max(latest, int(state["latest"]))
    refuse_past(latest, now)
    changes = find_changes(open_rows, source, dim, quarantine=quarantine)
    # hashed as the table's own type, so that a key has one bucket whatever type the source has
    kind, count = history.schema[_column(history, dim.key)].dataType, int(state["buckets"])
    changes = changes.withColumn(KEY_BUCKET, bucket_of(F.col(dim.key).cast(kind), count))
    per_bucket = changes.groupBy(KEY_BUCKET, ACTION).count().collect()  # bounded by the buckets
    if not per_bucket:
        return
    counts = {action: 0 for action in (DELETE, INSERT, UPDATE)}
    for row in per_bucket:
        counts[row[ACTION]] += row["count"]
    touched = sorted({row[KEY_BUCKET] for row in per_bucket})
    if len(touched) < count:
        open_rows = open_rows.where(F.col(KEY_BUCKET).isin(touched))
    merge = uuid.uuid4().hex
    staged = f"{table}__merge_{merge}"
    carried, added = next_versions(
        open_rows.drop(KEY_BUCKET), source, changes.drop(KEY_BUCKET), dim, as_of, start=highest + 1
    )
    rows = carried.unionByName(added).drop(ACTION)
    rows = rows.withColumn(KEY_BUCKET, bucket_of(F.col(dim.key).cast(kind), count))
    # one more shuffle of what is rewritten, so that a bucket is not split over a file per task
    rows = rows.hint("rebalance", "is_current", KEY_BUCKET)
    with settings(spark, _OPEN_WRITERS):
        rows.write.partitionBy("is_current", KEY_BUCKET).saveAsTable(staged)
    pending = {
        "merge": merge,
        "staged": staged,
        "previous": state.get("merge", ""),
        "closes": str(counts[DELETE] + counts[UPDATE]),
        "highest": str(highest + counts[INSERT] + counts[UPDATE]),
        "latest": str(now),
    }
    if synced is not None and spark.catalog.tableExists(synced):
        pending["synced"] = synced
    _set(spark, table, _PENDING, pending)


def _column(df: DataFrame, name: str) -> str:
    """A column's own spelling; names are matched without case."""
    return next(c for c in df.columns if c.lower() == name.lower())


def finish_merge(spark: SparkSession, table: str) -> None:
    """Apply the staged result of a merge, if one is pending. Repeating it changes nothing.

    Where the staged result is lost before a partition was touched, the merge is given up and a
    fresh one may follow; afterwards that is an error.
    """
    pending = _get(spark, table, _PENDING)
    if not pending:
        return
    held = _get(spark, table, _STATE)
    if not spark.catalog.tableExists(pending["staged"]):
        # the state is written after the last partition: then only the copy may be missing something
        if "begun" in pending and held.get("merge") != pending["merge"]:
            raise HistoryError(
                f"{pending['staged']} is gone, but the merge has begun to write {pending['begun']} of {table}"
            )
        log.warning("%s is gone; the merge of %s is given up", pending["staged"], table)
        _set(spark, table, _PENDING, {})
        return
    buckets = {"buckets": held["buckets"]}
    state = {name: pending[name] for name in ("merge", "highest", "latest")}
    _apply(spark, pending, table, marked=table)
    _set(spark, table, _STATE, state | buckets)
    synced = pending.get("synced")
    if synced is not None and _get(spark, synced, _STATE) == {"merge": pending["previous"]} | buckets:
        _set(spark, synced, _STATE, {})  # until it is whole again, it is at no merge
        _apply(spark, pending, synced, marked=table)
        _set(spark, synced, _STATE, {"merge": pending["merge"]} | buckets)
    _set(spark, table, _PENDING, {})
    spark.sql(f"DROP TABLE IF EXISTS {pending['staged']}")


def _apply(spark: SparkSession, pending: dict[str, str], target: str, *, marked: str) -> None:
    """Put the closed rows of the staged result into their partition, the open ones into their buckets."""
    staged, columns = spark.table(pending["staged"]), spark.table(target).columns
    _same_columns(staged.withColumn(CLOSED_IN, F.lit("")), columns, target)
    # the insert is by position: columns in the order of the table
    listed = ", ".join(f"`{c}`" for c in columns if c not in _PARTITIONS)
    filled: dict[str, set[int]] = {"true": set(), "false": set()}
    for row in spark.sql(f"SHOW PARTITIONS {pending['staged']}").collect():
        values = dict(part.split("=") for part in row["partition"].split("/"))
        filled[values["is_current"]].add(int(values[KEY_BUCKET]))

    def begin(what: str) -> None:
        _set(spark, marked, _PENDING, pending | {"begun": f"{what} in {target}"})

    if pending["closes"] != "0":
        begin("closed rows")
        spark.sql(
            f"INSERT OVERWRITE {target} "
            f"PARTITION (is_current = false, {CLOSED_IN} = '{pending['merge']}', {KEY_BUCKET} = {CLOSED}) "
            f"SELECT {listed} FROM {{staged}} WHERE NOT is_current",
            staged=staged,
        )
    begin("open rows")
    if filled["true"]:
        # only the buckets that the rows name are replaced
        with settings(spark, _DYNAMIC | _OPEN_WRITERS):
            spark.sql(
                f"INSERT OVERWRITE {target} "
                f"PARTITION (is_current = true, {CLOSED_IN} = 'open', {KEY_BUCKET}) "
                f"SELECT {listed}, `{KEY_BUCKET}` FROM {{staged}} WHERE is_current",
                staged=staged,
            )
    # a touched bucket that has closed rows and no open ones has become empty
    emptied = sorted(filled["false"] - filled["true"])
    if emptied:
        gone = ", ".join(
            f"PARTITION (is_current = true, {CLOSED_IN} = 'open', {KEY_BUCKET} = {bucket})"
            for bucket in emptied
        )
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {gone}")


def _catch_up(spark: SparkSession, table: str, synced: str) -> None:
    """Copy the whole history where its copy is not at the same merge."""
    held = _get(spark, table, _STATE)
    state = {name: held[name] for name in ("merge", "buckets")}
    if spark.catalog.tableExists(synced) and _get(spark, synced, _STATE) == state:
        return
    whole = spark.table(table).hint("rebalance", *_PARTITIONS)
    whole.write.mode("overwrite").partitionBy(*_PARTITIONS).saveAsTable(synced)
    _set(spark, synced, _STATE, state)


def _get(spark: SparkSession, table: str, prefix: str) -> dict[str, str]:
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {
        row["key"].removeprefix(prefix): row["value"]
        for row in properties
        if row["key"].startswith(prefix)
    }


def _set(spark: SparkSession, table: str, prefix: str, values: dict[str, str]) -> None:
    """Make the values those under the prefix."""
    gone = set(_get(spark, table, prefix)) - set(values)
    if values:
        listed = ", ".join(f"'{prefix}{name}' = '{value}'" for name, value in values.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
    if gone:
        listed = ", ".join(f"'{prefix}{name}'" for name in gone)
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({listed})")
