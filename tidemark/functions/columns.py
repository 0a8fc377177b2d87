"""Column helpers and whole-frame renames."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import MONTH_FORMAT, SECOND_FORMAT


def add_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Append ``suffix`` to every column name."""
    return df.toDF(*[name + suffix for name in df.columns])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Remove a trailing ``suffix`` from every column name that ends in it."""
    return df.toDF(*[name.removesuffix(suffix) for name in df.columns])


def lookup(code: str, labels: Mapping[int | str, str]) -> Column:
    """The label of a code; NULL for an unknown or missing code."""
    pairs = [F.lit(item) for item in chain.from_iterable(labels.items())]
    return F.create_map(*pairs)[F.col(code)]


def year_month(column: str) -> Column:
    """The month as the integer ``yyyyMM``."""
    return F.date_format(column, MONTH_FORMAT).cast("int")


def second_text(column: str) -> Column:
    """A timestamp as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(column, SECOND_FORMAT)


def text_timestamp(column: str) -> Column:
    """Text to timestamp; NULL where the text is no timestamp."""
    return F.try_to_timestamp(F.col(column))


def text_date(column: str) -> Column:
    """Text to date; NULL where the text is no date."""
    return F.col(column).try_cast("date")


def epoch_timestamp(column: str) -> Column:
    """Epoch seconds, as a number or as text, to timestamp; NULL where the text is no number."""
    return F.timestamp_seconds(F.col(column).try_cast("bigint"))


def profit(sell: str, buy: str, quantity: str) -> Column:
    """Margin per piece times pieces."""
    return (F.col(sell) - F.col(buy)) * F.col(quantity)
