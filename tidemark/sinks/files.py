"""File sinks. The default mode refuses a path that exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(
    df: DataFrame, path: str, *, header: bool = True, mode: str = "errorifexists"
) -> None:
    df.write.mode(mode).csv(path, header=header)


def write_parquet(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_lines(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """A frame with one text column as text files."""
    df.write.mode(mode).text(path)


def overwrite_directory(
    spark: SparkSession, path: str, query: str, file_format: str = "CSV"
) -> None:
    """Replace the files of a directory by the result of a SQL query."""
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING {file_format} {query}")
