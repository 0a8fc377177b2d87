"""Feed a stream slice by slice, as a schedule of runs on one checkpoint does, and look into its state."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.publish import publish_files


def time_slices(rows: DataFrame, time: str, count: int) -> Iterator[DataFrame]:
    """The rows in ``count`` spans of time of one length, earliest first.

    Rows without a time come with the first slice. A slice is a filter on the time, which reaches
    the scan, and not a copy; there are fewer slices where all rows are of few microseconds.
    """
    first, last = rows.agg(F.unix_micros(F.min(time)), F.unix_micros(F.max(time))).first()
    if first is None:
        yield rows
        return
    starts = sorted({first + i * (last + 1 - first) // count for i in range(count)})
    moments = [F.timestamp_micros(F.lit(start)) for start in starts]
    at = F.col(time)
    for i, moment in enumerate(moments):
        within = F.lit(True) if i == 0 else at >= moment
        if i + 1 < len(moments):
            within = within & (at < moments[i + 1])
        yield rows.filter(within | at.isNull() if i == 0 else within)


def run_slices(
    slices: Iterable[DataFrame], folder: str, start: Callable[[], StreamingQuery]
) -> int:
    """Publish each slice to the folder that a stream reads, and run the stream until it is used up.

    ``start`` starts the same stream on the same checkpoint each time, so state and watermark go
    on from slice to slice. The files of a slice make one batch, in whatever order they are listed:
    a watermark never meets the rows of one slice in part. Returns the number of batches with rows.
    """
    batches = 0
    for rows in slices:
        publish_files(rows, folder)
        query = start()
        query.awaitTermination()
        batches += sum(1 for progress in query.recentProgress if progress.numInputRows)
    return batches


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state of a stream of window counts holds after its last batch: ``keys..., start, end, total_counts``.

    Read through Spark's state store source. Windows that the watermark has closed in append mode
    have been handed on and are no longer there.
    """
    state = spark.read.format("statestore").load(checkpoint)
    counted = state.schema["value"].dataType.fieldNames()[-1]
    keys = [name for name in state.schema["key"].dataType.fieldNames()]
    shown = []
    for name in keys:
        column = F.col("key").getField(name)
        if "window" in name or "span" in name:
            shown += [column["start"].alias("start"), column["end"].alias("end")]
        else:
            shown.append(column.alias(name))
    return state.select(*shown, F.col("value").getField(counted).alias("total_counts"))
