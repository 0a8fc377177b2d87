"""File sources: CSV, text, Parquet, and rows written in the program."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.numbering import number_rows
from tidemark.session import stage


def rows(spark: SparkSession, values: Iterable[tuple], schema: str) -> DataFrame:
    """A small table of literal rows, such as a list of codes."""
    return spark.createDataFrame(list(values), schema)


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    header: bool,
    schema: str | None = None,
    infer: bool = False,
    separator: str = ",",
) -> DataFrame:
    """CSV files. Without a schema all columns are text, unless ``infer`` pays for a second pass.

    ``header`` has no default: a wrong one loses the first row of every file, or adds one.
    """
    reader = spark.read.option("header", header).option("sep", separator)
    if schema is not None:
        # With a header the file's own names are checked against the schema.
        reader = reader.schema(schema).option("enforceSchema", not header)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def csv_view(
    spark: SparkSession,
    name: str,
    columns: str,
    path: str,
    *,
    header: bool = False,
    separator: str = ",",
) -> None:
    """Name CSV files as a temporary SQL view with the given column list."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW `{name}` ({columns}) USING CSV "
        f"OPTIONS (path '{path}', sep '{separator}', header '{str(header).lower()}')"
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per line in the column ``value``."""
    return spark.read.text(path)


def in_written_order(df: DataFrame, *, name: str = "place") -> DataFrame:
    """Rows of a scan of files numbered from 0 in the order in which an ordered write left them.

    Files by name, their blocks by offset, rows within a block as they come: a sorted frame is
    written range by range, and Spark names the files by range.
    """
    scanned = df.select(
        "*",
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )
    placed = number_rows(stage(scanned, "scanned"), ["__file", "__block", "__row"], name=name, start=0)
    return placed.drop("__file", "__block", "__row")
