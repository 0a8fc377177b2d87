"""Message streams: any source whose rows carry a binary ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = "value BINARY"


def kafka_options(
    servers: str, topic: str, starting: str = "latest", **more: str
) -> dict[str, str]:
    """Subscription to one topic. ``starting`` counts for the first run of a checkpoint only.

    ``more`` takes e.g. ``maxOffsetsPerTrigger``, which bounds the first batch after a long stop,
    and ``minPartitions``, which reads a topic of few partitions with more tasks.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **more,
    }


def read_messages(spark: SparkSession, source_format: str, **options: str) -> DataFrame:
    """A stream of messages from a broker, e.g. ``**kafka_options(...)`` with format ``kafka``."""
    return spark.readStream.format(source_format).options(**options).load().select("value")


def read_message_files(
    spark: SparkSession, path: str, *, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of messages from a folder of Parquet files, see ``streaming.publish``."""
    return read_file_stream(spark, path, MESSAGE_SCHEMA, files_per_batch=files_per_batch)


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    *,
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream over the Parquet files of a folder, optionally only names that match ``glob``."""
    reader = spark.readStream.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
