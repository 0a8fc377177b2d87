"""Decode message values: JSON text to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import STORE_SALE_SCHEMA, TRIP_SCHEMA
from tidemark.functions.columns import epoch_timestamp


def parse_messages(messages: DataFrame, schema: str) -> DataFrame:
    """One row per message. A malformed document or field gives NULLs and stops nothing."""
    return (
        messages.selectExpr("CAST(value AS STRING) AS value")
        .select(F.from_json("value", schema).alias("message"))
        .select("message.*")
    )


def parse_trips(messages: DataFrame) -> DataFrame:
    return parse_messages(messages, TRIP_SCHEMA)


def parse_store_sales(messages: DataFrame) -> DataFrame:
    """Store sales; ``eventTime`` arrives as epoch seconds in text and leaves as a timestamp."""
    sales = parse_messages(messages, STORE_SALE_SCHEMA)
    return sales.withColumn("eventTime", epoch_timestamp("eventTime"))
