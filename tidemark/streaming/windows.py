"""Counts per time window: tumbling, sliding, and sessions with a fixed or a per-row gap.

Each function takes a batch or a streaming frame. On a stream, ``watermark`` bounds how late a row
may be; it takes effect in append mode, while complete mode keeps all state and counts late rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.fixed_values import LONG_GAP, SHORT_GAP, SHORT_GAP_STORE
from tidemark.session import stage


def window_counts(
    events: DataFrame,
    time: str,
    counted: str,
    duration: str,
    *,
    slide: str | None = None,
    keys: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Rows with a non-NULL ``counted`` per window (and key): ``keys, total_counts, start, end``.

    Without ``slide`` the windows tumble. Counts are combined before the shuffle, so a window or
    key that holds most rows costs one row per task.
    """
    events = _watermarked(events, time, watermark)
    return _window_columns(
        events.groupBy(*keys, F.window(time, duration, slide).alias("span")).agg(
            F.count(counted).alias("total_counts")
        ),
        keys,
    )


def session_counts(
    events: DataFrame,
    time: str,
    counted: str,
    gap: str | Column,
    *,
    keys: Sequence[str] = (),
    watermark: str | None = None,
    span: str = "1 day",
) -> DataFrame:
    """Rows per session and key: ``keys, total_counts, start, end``.

    A row opens ``[time, time + gap)`` and intervals that meet form one session. ``gap`` is a
    duration or a column of durations. A finite frame is cut into ranges of ``span`` that are
    sorted apart; it changes the work, not the result.
    """
    if not events.isStreaming:
        return _session_counts_batch(events, time, counted, gap, keys, span)
    events = _watermarked(events, time, watermark)
    return _window_columns(
        events.groupBy(*keys, F.session_window(time, gap).alias("span")).agg(
            F.count(counted).alias("total_counts")
        ),
        keys,
    )


def store_gap(store: str = "Store_id") -> Column:
    """The session gap of a store sale."""
    return F.when(F.col(store) == SHORT_GAP_STORE, F.lit(SHORT_GAP)).otherwise(F.lit(LONG_GAP))


def _watermarked(events: DataFrame, time: str, watermark: str | None) -> DataFrame:
    if watermark is None or not events.isStreaming:
        return events
    return events.withWatermark(time, watermark)


def _window_columns(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counts.select(
        *keys, "total_counts", F.col("span.start").alias("start"), F.col("span.end").alias("end")
    )


def _session_counts_batch(
    events: DataFrame, time: str, counted: str, gap: str | Column, keys: Sequence[str], span: str
) -> DataFrame:
    """Sessions of a finite frame, without sorting all rows of a key in one task.

    Rows of one key that share a gap and a time slot as wide as this gap are less than the gap
    apart, so they are one session. An ordinary count per slot, combined before the shuffle,
    therefore shrinks a busy key to at most one row per slot. Slots are joined up to sessions
    within ranges of ``span``; then one row per range tells how far earlier ranges reach, and which
    session reaches that far. So neither a busy key nor a frame without keys is sorted in one task.
    The sessions within ranges are written to the scratch folder, as they are read twice.
    """
    duration = F.lit(gap) if isinstance(gap, str) else gap
    at = F.unix_micros(time)
    width = F.unix_micros(F.col(time) + duration.cast("interval")) - at
    slots = (
        events.select(
            *keys, F.col(counted).alias("__counted"), at.alias("__at"), width.alias("__gap")
        )
        .filter("__at IS NOT NULL AND __gap > 0")
        .groupBy(*keys, "__gap", (F.col("__at") - F.pmod("__at", "__gap")).alias("__slot"))
        .agg(
            F.count("__counted").alias("__count"),
            F.min("__at").alias("__start"),
            (F.max("__at") + F.col("__gap")).alias("__end"),
        )
        .withColumn("__range", F.col("__start") - F.pmod("__start", _micros(span)))
    )
    in_order = Window.partitionBy(*keys, "__range").orderBy("__start", "__end")
    reached = F.max("__end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = stage(
        slots.withColumn("__opens", _opens(reached).cast("int"))
        .withColumn("__session", F.sum("__opens").over(so_far))
        .groupBy(*keys, "__range", "__session")
        .agg(
            F.sum("__count").alias("__count"),
            F.min("__start").alias("__start"),
            F.max("__end").alias("__end"),
        ),
        "sessions",
    )
    # one row per range: only the last session of a range can be reached from later ones, and
    # sessions that begin within the reach of earlier ranges come before all others of their range
    earlier = Window.partitionBy(*keys, "__all").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        local.groupBy(*keys, "__range")
        .agg(F.max("__end").alias("__end"), F.max("__start").alias("__start"))
        .withColumn("__all", F.col("__range") < F.lit(-(2**62)))  # the same for all
        .withColumn("__reached", F.max("__end").over(earlier))
        .withColumn("__opener", F.when(_opens(F.col("__reached")), F.col("__start")))
        .withColumn("__before", F.max("__opener").over(earlier))
    )
    names = [f"__key{i}" for i in range(len(keys))]
    renamed = carried.select(
        *(F.col(k).alias(n) for k, n in zip(keys, names)),
        F.col("__range").alias("__of"), "__reached", "__before",
    )
    same = F.col("__range") == F.col("__of")
    for key, name in zip(keys, names):
        same = same & F.col(key).eqNullSafe(F.col(name))
    begun = F.when(_opens(F.col("__reached")), F.col("__start")).otherwise(F.col("__before"))
    return (
        local.join(renamed, same)
        .groupBy(*keys, begun.alias("__begun"))
        .agg(
            F.sum("__count").alias("total_counts"),
            F.timestamp_micros(F.min("__start")).alias("start"),
            F.timestamp_micros(F.max("__end")).alias("end"),
        )
        .drop("__begun")
    )


def _opens(reached: Column) -> Column:
    """Whether a start lies beyond all that came before it."""
    return reached.isNull() | (F.col("__start") > reached)


def _micros(duration: str) -> Column:
    """A duration in microseconds; a literal after constant folding."""
    start = F.timestamp_micros(F.lit(0).cast("long"))
    return F.unix_micros(start + F.lit(duration).cast("interval"))
