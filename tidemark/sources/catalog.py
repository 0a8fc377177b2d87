"""Databases and tables of the Spark catalog."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE `{name}`{place}")


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop a database and all its tables, if it exists."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE DATABASE `{name}`")


def create_table(
    spark: SparkSession, name: str, columns: str, table_format: str = "parquet"
) -> None:
    """An empty managed table; ``delta`` works where its extension is installed."""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {table_format}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


@contextmanager
def named_views(spark: SparkSession, **frames: DataFrame) -> Iterator[None]:
    """Frames under names for SQL, as long as the block lasts. Results made in it stay usable."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)
