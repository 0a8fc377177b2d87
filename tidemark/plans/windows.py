"""Streaming windows over the events, and sessions of the same events as a batch.

The events are published slice by slice. After each slice the stream runs until it is used up, on
the same checkpoint, so its state and its watermark go through several batches; the counts are left
in the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.plans.tables import zoned_events
from tidemark.session import scratch_path
from tidemark.sources.messages import read_file_stream
from tidemark.streaming.sinks import for_each_batch, latest_result, read_latest, to_files
from tidemark.streaming.slices import open_windows, run_slices, time_slices
from tidemark.streaming.windows import session_counts, window_counts

#: Slices of the events, so batches of each stream.
SLICES = 5

COUNTS = "total_counts BIGINT, start TIMESTAMP, end TIMESTAMP"
KEYED_COUNTS = f"event_type STRING, {COUNTS}"

TUMBLING_SQL = """
SELECT count(event_type) AS total_counts, time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end
FROM events GROUP BY time_bucket(INTERVAL '1 hour', ts)
"""

SLIDING_SQL = """
SELECT event_type, count(event_type) AS total_counts, window_start,
       window_start + INTERVAL '2 hours' AS window_end
FROM (SELECT event_type,
             unnest([time_bucket(INTERVAL '1 hour', ts),
                     time_bucket(INTERVAL '1 hour', ts) - INTERVAL '1 hour']) AS window_start
      FROM events)
GROUP BY event_type, window_start
"""

SESSION_SQL = """
WITH spans AS (
    SELECT event_type, ts AS started, ts + {gap} AS ended FROM events),
reach AS (
    SELECT *, max(ended) OVER (PARTITION BY event_type ORDER BY started, ended
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
    FROM spans),
numbered AS (
    SELECT *, sum(CASE WHEN reached IS NULL OR started > reached THEN 1 ELSE 0 END)
              OVER (PARTITION BY event_type ORDER BY started, ended
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session
    FROM reach)
SELECT event_type, count(event_type) AS total_counts, min(started) AS window_start,
       max(ended) AS window_end
FROM numbered GROUP BY event_type, session
"""
FIXED_GAP_SQL = SESSION_SQL.format(gap="INTERVAL '1 hour'")
ROW_GAP_SQL = SESSION_SQL.format(
    gap="CASE WHEN event_type = 'error' THEN INTERVAL '20 minutes' ELSE INTERVAL '2 hours' END"
)

WATERMARK_SQL = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '1 hour' FROM events)"
CLOSED_SQL = f"SELECT * FROM ({TUMBLING_SQL}) WHERE window_end <= {WATERMARK_SQL}"
OPEN_SQL = f"SELECT * FROM ({TUMBLING_SQL}) WHERE window_end > {WATERMARK_SQL}"
CLOSED_SESSIONS_SQL = f"""
SELECT * FROM ({SESSION_SQL.format(gap="INTERVAL '20 minutes'")}) WHERE window_end <= {WATERMARK_SQL}
"""


def shown(counts):
    return counts.withColumnsRenamed({"start": "window_start", "end": "window_end"}).withColumns(
        {
            "window_start": F.col("window_start").cast("timestamp_ntz"),
            "window_end": F.col("window_end").cast("timestamp_ntz"),
        }
    )


def run_complete(spark, slices, counts, schema):
    """Run a stream of counts in complete mode, slice after slice; its latest full result.

    ``counts`` gets the folder that the slices are published to.
    """
    topic, path = scratch_path(spark, "topic"), scratch_path(spark, "counts")
    checkpoint = scratch_path(spark, "counts-progress")

    def start():
        return for_each_batch(counts(topic), latest_result(path), checkpoint, mode="complete")

    run_slices(slices, topic, start)
    return shown(read_latest(spark, path, schema))


def run_append(spark, slices, counts):
    """Run a stream of counts in append mode; the folder of its results and its checkpoint."""
    topic, path = scratch_path(spark, "topic"), scratch_path(spark, "counts")
    checkpoint = scratch_path(spark, "counts-progress")
    run_slices(slices, topic, lambda: to_files(counts(topic), path, checkpoint))
    return path, checkpoint


def _slices(spark, sf_dir):
    return time_slices(_zoned_events(spark, sf_dir), "ts", SLICES)


def _counted(spark, sf_dir, count):
    """A function from a folder of events to a stream of their counts."""
    schema = _zoned_events(spark, sf_dir).schema
    return lambda topic: count(read_file_stream(spark, topic, schema))


def _row_gap():
    is_error = F.col("event_type") == "error"
    return F.when(is_error, F.lit("20 minutes")).otherwise(F.lit("2 hours"))


def _zoned_events(spark, sf_dir):
    return zoned_events(spark, sf_dir).select("event_type", "ts")


def _complete(spark, sf_dir, count, schema):
    return run_complete(spark, _slices(spark, sf_dir), _counted(spark, sf_dir, count), schema)


def _hourly(events, watermark):
    return window_counts(events, "ts", "event_type", "1 hour", watermark=watermark)


@query(TUMBLING_SQL)
def win_tumbling(spark, sf_dir):
    """Events per hour, all windows so far."""
    return _complete(spark, sf_dir, lambda events: _hourly(events, "1 minute"), COUNTS)


def _append(spark, sf_dir):
    counts = _counted(spark, sf_dir, lambda events: _hourly(events, "1 hour"))
    return run_append(spark, _slices(spark, sf_dir), counts)


@query(CLOSED_SQL)
def win_tumbling_append(spark, sf_dir):
    """Events per hour, each window once it can no longer change."""
    path, _ = _append(spark, sf_dir)
    return shown(spark.read.schema(COUNTS).parquet(path))


@query(OPEN_SQL)
def win_tumbling_open(spark, sf_dir):
    """The hours that are still in the state after the last batch; all closed ones have left it."""
    _, checkpoint = _append(spark, sf_dir)
    return shown(open_windows(spark, checkpoint))


@query(SLIDING_SQL)
def win_sliding(spark, sf_dir):
    """Events per type in two-hour windows that start every hour."""

    def count(events):
        return window_counts(
            events,
            "ts",
            "event_type",
            "2 hours",
            slide="1 hour",
            keys=["event_type"],
            watermark="30 seconds",
        )

    return _complete(spark, sf_dir, count, KEYED_COUNTS)


def _sessions(gap, watermark):
    return lambda events: session_counts(
        events, "ts", "event_type", gap, keys=["event_type"], watermark=watermark
    )


@query(FIXED_GAP_SQL)
def win_session(spark, sf_dir):
    """Events per type and session; a session ends after an hour without events."""
    return _complete(spark, sf_dir, _sessions("1 hour", "1 minute"), KEYED_COUNTS)


@query(CLOSED_SESSIONS_SQL)
def win_session_append(spark, sf_dir):
    """Sessions of twenty minutes, each once it can no longer grow."""
    counts = _counted(spark, sf_dir, _sessions("20 minutes", "1 hour"))
    path, _ = run_append(spark, _slices(spark, sf_dir), counts)
    return shown(spark.read.schema(KEYED_COUNTS).parquet(path))


@query(ROW_GAP_SQL)
def win_session_dynamic(spark, sf_dir):
    """Sessions whose gap depends on the row."""
    return _complete(spark, sf_dir, _sessions(_row_gap(), "5 minutes"), KEYED_COUNTS)


@query(TUMBLING_SQL)
def win_tumbling_batch(spark, sf_dir):
    return shown(window_counts(_zoned_events(spark, sf_dir), "ts", "event_type", "1 hour"))


@query(SLIDING_SQL)
def win_sliding_batch(spark, sf_dir):
    events = _zoned_events(spark, sf_dir)
    return shown(
        window_counts(
            events, "ts", "event_type", "2 hours", slide="1 hour", keys=["event_type"]
        )
    )


@query(FIXED_GAP_SQL)
def win_session_batch(spark, sf_dir):
    events = _zoned_events(spark, sf_dir)
    return shown(session_counts(events, "ts", "event_type", "1 hour", keys=["event_type"]))


@query(ROW_GAP_SQL)
def win_session_dynamic_batch(spark, sf_dir):
    events = _zoned_events(spark, sf_dir)
    return shown(session_counts(events, "ts", "event_type", _row_gap(), keys=["event_type"]))
