"""Type-2 slowly changing dimension: keep every version of a row, one of them open per key.

A history frame has the source columns plus a surrogate key, ``effective_date``,
``expiration_date`` and ``is_current``. Comparing it with the current source gives one action per
key:

* ``NOCHANGE``  tracked columns are equal: the history row stays, untracked changes are ignored;
* ``DELETE``    key is gone: the open row is closed;
* ``INSERT``    key has no open row: a new open row, also for a key that comes back;
* ``UPDATE``    tracked columns differ: the open row is closed and a new open row added.

New rows get surrogate keys above the highest key of the whole history: inserts in key order, then
updates in key order.

Keys and tracked columns alone decide what happens, so they are compared first and the changed
keys are written down. The whole rows are then joined with these keys only: where few keys change,
Spark broadcasts them and the rows are not shuffled at all.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.fixed_values import OPEN_END
from tidemark.functions.hashing import differs
from tidemark.operators.numbering import number_rows
from tidemark.session import stage

NOCHANGE, DELETE, INSERT, UPDATE = "NOCHANGE", "DELETE", "INSERT", "UPDATE"
ACTION = "scd2_action"

#: Takes the source rows that have no key, and their number.
Quarantine = Callable[[DataFrame, int], None]

log = logging.getLogger(__name__)


class HistoryError(ValueError):
    """The source or the history breaks the contract of the dimension."""


@dataclass(frozen=True)
class Dimension:
    """Names of the business key, the surrogate key and the tracked columns.

    ``time_type`` is the type of ``effective_date`` and ``expiration_date``: ``timestamp``, or
    ``date`` for a history kept by day.
    """

    key: str
    surrogate: str
    tracked: Sequence[str]
    time_type: str = "timestamp"

    def history_columns(self, source_columns: Sequence[str]) -> list[str]:
        return [*source_columns, self.surrogate, "effective_date", "expiration_date", "is_current"]

    def moment(self, value: datetime | str | Column | None) -> Column:
        """A time of the history; ``None`` is the present, fixed by this call."""
        if value is None:
            value = datetime.now(timezone.utc)
        value = value if isinstance(value, Column) else F.lit(value)
        return value.cast("timestamp").cast(self.time_type)

    def open_end(self) -> Column:
        return self.moment(OPEN_END)

    def clock(self, moment: Column) -> Column:
        """A time of the history as a number that does not depend on the session's zone."""
        return (F.unix_date if self.time_type == "date" else F.unix_micros)(moment).cast("long")


def split_history(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Open rows and closed rows."""
    return history.filter("is_current"), history.filter("NOT is_current")


def split_missing_keys(source: DataFrame, dim: Dimension) -> tuple[DataFrame, DataFrame]:
    """Rows with a business key, and rows to quarantine because they have none."""
    key = F.col(dim.key)
    return source.filter(key.isNotNull()), source.filter(key.isNull())


def classify(open_rows: DataFrame, source: DataFrame, dim: Dimension) -> DataFrame:
    """The action of every key: ``key, scd2_action, h_repeated, c_repeated``.

    ``h_repeated`` and ``c_repeated`` tell whether the history and the source hold the key more
    than once; then one of its rows speaks for all. Rows without a key are left out. The narrow
    rows of each side are shuffled and sorted once: the sort of the join also brings copies of a
    key together, so the first row of each key goes into the join and no other.
    """
    held, given = (_first_of_key(df, dim, side) for df, side in ((open_rows, "h"), (source, "c")))
    action = (
        F.when(F.col("c_key").isNull(), DELETE)
        .when(F.col("h_key").isNull(), INSERT)
        .when(differs("h", "c", dim.tracked), UPDATE)
        .otherwise(NOCHANGE)
    )
    flags = (F.coalesce(f"{side}_repeated", F.lit(False)).alias(f"{side}_repeated") for side in "hc")
    return held.join(given, F.col("h_key") == F.col("c_key"), "full_outer").select(
        F.coalesce("h_key", "c_key").alias("key"), action.alias(ACTION), *flags
    )


def _first_of_key(df: DataFrame, dim: Dimension, side: str) -> DataFrame:
    """One row of each key with its tracked columns, and whether there are more of them."""
    key = f"{side}_key"
    copies = Window.partitionBy(key).orderBy(key)  # the order that the join needs anyway
    return (
        df.select(F.col(dim.key).alias(key), F.struct(*dim.tracked).alias(side))
        .filter(F.col(key).isNotNull())
        .withColumn("row", F.row_number().over(copies))
        .withColumn(f"{side}_repeated", F.lead(F.lit(True)).over(copies))
        .filter("row = 1")
        .drop("row")
    )


def find_changes(
    open_rows: DataFrame, source: DataFrame, dim: Dimension, *, quarantine: Quarantine | None = None
) -> DataFrame:
    """The keys that change, written to the scratch folder: ``<key>, scd2_action``.

    Raises ``HistoryError`` where a key has several live rows, and where source rows have no key
    and there is no ``quarantine`` to take them.
    """
    _set_aside(source, dim, quarantine)
    changed = (F.col(ACTION) != NOCHANGE) | F.col("h_repeated") | F.col("c_repeated")
    found = stage(classify(open_rows, source, dim).filter(changed), "changes")
    for side, flag, df in (("history", "h_repeated", open_rows), ("source", "c_repeated", source)):
        examples = [row["key"] for row in found.filter(flag).select("key").limit(10).collect()]
        _refuse_repeated(side, df.filter(F.col(dim.key).isin(examples)) if examples else None, dim)
    return found.select(F.col("key").alias(dim.key), ACTION)


def _set_aside(source: DataFrame, dim: Dimension, quarantine: Quarantine | None) -> None:
    """Source rows without a key are refused or handed over."""
    unkeyed = split_missing_keys(source, dim)[1]
    missing = unkeyed.count()
    if missing and quarantine is None:
        raise HistoryError(f"{missing} source rows have no {dim.key}; name a quarantine for them")
    if missing:
        log.warning("%d source rows without %s go to the quarantine", missing, dim.key)
        quarantine(unkeyed, missing)


def _refuse_repeated(side: str, rows: DataFrame | None, dim: Dimension) -> None:
    """Refuse the rows if they hold a key more than once; ten examples are enough for the message."""
    if rows is None:
        return
    counts = rows.groupBy(F.col(dim.key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    repeated = counts.filter("rows > 1 AND key IS NOT NULL").limit(10).collect()
    if repeated:
        shown = ", ".join(f"{side} {row['key']!r} x{row['rows']}" for row in repeated)
        raise HistoryError(f"keys with more than one live row: {shown}")


def history_ends(
    history: DataFrame, dim: Dimension, as_of: datetime | Column | None = None
) -> tuple[int, int, int]:
    """The highest surrogate key (0 where there are none), the latest time, and ``as_of``.

    All rows count, open or closed; times are numbers of ``Dimension.clock``, the latest being that
    of a row's start or of a closed row's end. The same pass refuses a history with rows that are
    neither open nor closed.
    """
    ended = F.when(~F.col("is_current"), F.col("expiration_date"))
    latest = F.max(F.greatest(dim.clock(F.col("effective_date")), dim.clock(ended)))
    moment = dim.moment(as_of)
    highest, unset, latest, now = history.agg(
        F.coalesce(F.max(dim.surrogate), F.lit(0)),
        F.count_if(F.col("is_current").isNull()),
        latest,
        F.max(dim.clock(moment)),
    ).first()
    if now is None:  # no rows
        now = history.sparkSession.range(1).select(dim.clock(moment)).first()[0]
    if unset:
        raise HistoryError(f"history holds {unset} rows whose is_current is NULL")
    return highest, now if latest is None else latest, now


def refuse_past(latest: int, now: int) -> None:
    """Changes follow one another: none may take effect before what the history holds."""
    if now < latest:
        raise HistoryError(f"as_of lies {latest - now} microseconds or days before the last change")


def number_changes(changes: DataFrame, dim: Dimension, *, start: int) -> DataFrame:
    """Surrogate keys of the rows to add: ``<key>, scd2_action, <surrogate>``."""
    added = changes.filter(F.col(ACTION).isin(INSERT, UPDATE))
    # "INSERT" sorts before "UPDATE".
    return number_rows(added, [ACTION, dim.key], name=dim.surrogate, start=start)


def carried_versions(
    open_rows: DataFrame,
    changes: DataFrame,
    dim: Dimension,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """The open rows after the change: kept as they are, or closed where the key changed."""
    ended = F.col(ACTION).isNotNull()
    changed = changes.filter(F.col(ACTION).isin(DELETE, UPDATE))
    return (
        open_rows.join(changed, dim.key, "left")
        .withColumns(
            {
                "expiration_date": F.when(ended, dim.moment(as_of)).otherwise(
                    F.col("expiration_date")
                ),
                "is_current": ~ended,
                ACTION: F.coalesce(ACTION, F.lit(NOCHANGE)),
            }
        )
        .select(*open_rows.columns, ACTION)
    )


def added_versions(
    source: DataFrame,
    numbered: DataFrame,
    dim: Dimension,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """A new open row for every numbered key, with all columns of the source."""
    return (
        source.join(numbered, dim.key)
        .withColumns(
            {
                "effective_date": dim.moment(as_of),
                "expiration_date": dim.open_end(),
                "is_current": F.lit(True),
            }
        )
        .select(*dim.history_columns(source.columns), ACTION)
    )


def scd2_versions(
    history: DataFrame,
    source: DataFrame,
    dim: Dimension,
    *,
    as_of: datetime | Column | None = None,
    quarantine: Quarantine | None = None,
) -> DataFrame:
    """What becomes of every live key: history rows, each with the ``scd2_action`` it follows from.

    Finds and numbers the changes at once; the join of the whole rows stays lazy. ``as_of`` must
    not lie before the last change of the history.
    """
    as_of = dim.moment(as_of)
    open_rows, _ = split_history(history.select(dim.history_columns(source.columns)))
    highest, latest, now = history_ends(history, dim, as_of)
    refuse_past(latest, now)
    changes = find_changes(open_rows, source, dim, quarantine=quarantine)
    carried, added = next_versions(open_rows, source, changes, dim, as_of, start=highest + 1)
    return carried.unionByName(added)


def next_versions(
    open_rows: DataFrame,
    source: DataFrame,
    changes: DataFrame,
    dim: Dimension,
    as_of: datetime | Column | None,
    *,
    start: int,
) -> tuple[DataFrame, DataFrame]:
    """The open rows, and the added ones, after known changes, numbered from ``start``."""
    numbered = number_changes(changes, dim, start=start)
    carried = carried_versions(open_rows, changes, dim, as_of)
    return carried, added_versions(source, numbered, dim, as_of)


def scd2_merge(
    history: DataFrame,
    source: DataFrame,
    dim: Dimension,
    *,
    as_of: datetime | Column | None = None,
    quarantine: Quarantine | None = None,
) -> DataFrame:
    """The next history: closed rows as they are, plus what follows for every live key.

    ``as_of`` is the time of the change (default: now, fixed when the call is made). ``source``
    and ``history`` are read more than once and must not change meanwhile. Source rows without a
    key are an error, or go to ``quarantine``.
    """
    _, closed = split_history(history.select(dim.history_columns(source.columns)))
    versions = scd2_versions(history, source, dim, as_of=as_of, quarantine=quarantine)
    return closed.unionByName(versions.drop(ACTION))


def scd2_initial(
    source: DataFrame,
    dim: Dimension,
    *,
    as_of: datetime | Column | None = None,
    quarantine: Quarantine | None = None,
) -> DataFrame:
    """The first history: every source row with a key open, numbered in key order from 1."""
    _set_aside(source, dim, quarantine)
    _refuse_repeated("source", source, dim)
    keys = split_missing_keys(source, dim)[0].select(dim.key, F.lit(INSERT).alias(ACTION))
    return added_versions(source, number_changes(keys, dim, start=1), dim, as_of).drop(ACTION)
