"""Turn typed rows into messages, and publish them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.fixed_values import STORE_SALE_SCHEMA, TRIP_SCHEMA

# Times keep their microseconds; the default would cut them to milliseconds.
_WHOLE_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def payload(records: DataFrame) -> Column:
    """All columns as one JSON document in bytes; a NULL is left out."""
    return F.to_json(F.struct(*records.columns), _WHOLE_TIMES).cast("binary")


def to_messages(records: DataFrame) -> DataFrame:
    """One JSON document per row in the binary column ``value``."""
    return records.select(payload(records).alias("value"))


def trip_messages(trips: DataFrame) -> DataFrame:
    """Trip records, e.g. all-text CSV columns, as messages typed by ``TRIP_SCHEMA``."""
    return to_messages(_typed(trips, TRIP_SCHEMA))


def store_sale_messages(sales: DataFrame) -> DataFrame:
    """Store sales as messages; the timestamp ``eventTime`` is sent as a number of epoch seconds."""
    sent = sales.withColumn("eventTime", F.unix_timestamp("eventTime"))
    as_number = STORE_SALE_SCHEMA.replace("eventTime STRING", "eventTime BIGINT")
    return to_messages(_typed(sent, as_number))


def publish_files(messages: DataFrame, path: str, *, messages_per_file: int = 200_000) -> None:
    """Add messages to a folder that ``read_message_files`` streams from.

    The bound per file lets readers share one writer's output, and bound their batches by files.
    """
    messages.write.mode("append").option("maxRecordsPerFile", messages_per_file).parquet(path)


def publish_broker(messages: DataFrame, sink_format: str, **options: str) -> None:
    """Send messages through a connector, e.g. ``kafka`` with its servers and ``topic``."""
    messages.write.format(sink_format).options(**options).save()


def _typed(records: DataFrame, ddl: str) -> DataFrame:
    """Cast the columns that the schema names, bad text to NULL; leave out those it does not."""
    fields = StructType.fromDDL(ddl).fields
    present = set(records.columns)
    return records.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields if f.name in present]
    )
