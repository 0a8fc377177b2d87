"""A log of messages in order, read in chunks of a fixed number of messages.

A log is a folder with ``messages``, as few files as there are ranges of the order, and
``manifest``, which tells for each chunk the files that hold it and the positions in them. The
number of files depends on the data, never on the size of a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.fixed_values import CHUNK_SIZE
from tidemark.operators.numbering import PART, POSITION, in_ranges
from tidemark.session import if_present
from tidemark.streaming.publish import payload

#: ``shift`` added to the place of a message in its file gives its position in the log.
MANIFEST = "chunk BIGINT, file STRING, shift BIGINT, first BIGINT, last BIGINT"


def publish_chunks(
    records: DataFrame, order_by: Sequence[str], path: str, size: int = CHUNK_SIZE
) -> None:
    """Publish rows in order as the log ``path``: the first ``size`` make chunk 0, and so on.

    One shuffle by range and one write of the messages. A second pass reads only the places to see
    how many messages each file holds, one row per file; chunks may go over the ends of files.
    """
    spark = records.sparkSession
    messages = f"{path}/messages"
    placed = in_ranges(records, order_by)
    placed.select(PART, POSITION, payload(records).alias("value")).write.parquet(messages)
    files = (
        spark.read.parquet(messages)
        .groupBy(PART, F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(POSITION).alias("least"))
    )
    earlier = Window.orderBy(PART, "least").rowsBetween(Window.unboundedPreceding, -1)
    start, wide = F.coalesce(F.sum("rows").over(earlier), F.lit(0)), F.lit(size).cast("long")
    spans = files.withColumn("start", start).withColumn("end", F.col("start") + F.col("rows") - 1)
    chunks = F.sequence(F.floor(F.col("start") / wide), F.floor(F.col("end") / wide))
    entries = spans.withColumn("chunk", F.explode(chunks)).select(
        F.col("chunk").cast("long").alias("chunk"),
        "file",
        (F.col("start") - F.col("least")).alias("shift"),
        F.greatest("start", F.col("chunk") * wide).alias("first"),
        F.least("end", (F.col("chunk") + 1) * wide - 1).alias("last"),
    )
    entries.repartitionByRange("chunk").sortWithinPartitions("chunk", "first").write.parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Where the chunks of a log are: ``chunk, file, shift, first, last``."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_chunks(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """``chunk, position, value`` of the messages of some chunks; no other file is opened."""
    wanted = manifest(spark, path).filter(F.col("chunk").between(first, last))
    files = [row["file"] for row in wanted.select("file").distinct().collect()]  # at most the files of the log
    rows = spark.read.schema(f"{PART} INT, {POSITION} BIGINT, value BINARY").parquet(*files or [f"{path}/messages"])
    if not files:
        return rows.select(F.lit(0).cast("long").alias("chunk"), F.col(POSITION).alias("position"), "value").limit(0)
    placed = rows.select(F.col("_metadata.file_path").alias("of"), F.col(POSITION).alias("place"), "value")
    at = F.col("place") + F.col("shift")
    held = placed.join(wanted, (F.col("of") == F.col("file")) & at.between(F.col("first"), F.col("last")))
    return held.select("chunk", at.alias("position"), "value")


def for_each_chunk(
    spark: SparkSession,
    path: str,
    write: Callable[[DataFrame, int], None],
    progress: str,
    *,
    chunks: int = 1,
) -> int:
    """Hand the chunks of a log over in order, ``chunks`` at a time: ``write(rows, first_chunk)``.

    The folder ``progress`` notes what was taken, so a reader that died goes on where it was; the
    hand-over it died in is repeated, and ``write`` must then have the same effect. Returns the
    number of hand-overs.
    """
    end = manifest(spark, path).agg(F.max("chunk")).first()[0]
    noted = if_present(spark.read.schema("next BIGINT"), progress)
    at = 0 if noted is None else noted.agg(F.max("next")).first()[0] or 0
    taken = 0
    while end is not None and at <= end:
        write(read_chunks(spark, path, at, at + chunks - 1), at)
        at, taken = at + chunks, taken + 1
        spark.range(1).select(F.lit(at).cast("long").alias("next")).coalesce(1).write.mode("append").parquet(progress)
    return taken
