"""Dense row numbers over one global order, without collecting the rows in one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

PART = "__part"
POSITION = "__position"
_ID = "__id"


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    *,
    name: str = "row_number",
    start: int = 1,
    copies: bool = False,
) -> DataFrame:
    """Append ``start``, ``start + 1``, ... in the order of ``order_by``.

    Equals ``row_number() over (order by ...)``, which Spark plans as a single partition. Here the
    rows are range-partitioned and sorted, written to the shared scratch folder together with
    their partition and position, and shifted by the row counts of the earlier partitions.

    Rows with equal values are ordered by a hash of their other columns. So the numbering is
    reproducible, and a value that most rows share is spread over several ranges. Only whole
    copies of a row stay together. With ``copies`` these are spread as well: the rows are written
    once before, each with an id that a repeated task cannot change, and the id parts the copies.
    """
    columns = df.columns
    if copies:
        df = stage(unique_ids(df, name=_ID), "identified")
    placed = stage(in_ranges(df, order_by, last=_ID if copies else None), "numbered")
    # One row per partition, so neither the ordered window nor the broadcast grows with the data.
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(PART)
        .agg(F.count(F.lit(1)).alias("rows"), F.min(POSITION).alias("first"))
        .select(
            PART,
            (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        )
    )
    number = F.col(POSITION) + F.col("shift") + F.lit(start)
    return placed.join(F.broadcast(offsets), PART).select(
        *columns, number.cast("long").alias(name)
    )


def in_ranges(df: DataFrame, order_by: Sequence[str], *, last: str | None = None) -> DataFrame:
    """Rows in global order, each with its partition and its position; to be written before it is used.

    Rows that are equal in ``order_by`` are ordered by a hash of the other columns, then by ``last``.
    """
    others = [name for name, kind in df.dtypes if name not in (*order_by, last) and "map<" not in kind]
    keys = [F.col(name) for name in order_by] + ([F.xxhash64(*others)] if others else [])
    keys += [F.col(last)] if last is not None else []
    return (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns(
            {PART: F.spark_partition_id(), POSITION: F.monotonically_increasing_id()}
        )
    )


def unique_ids(df: DataFrame, *, name: str = "id") -> DataFrame:
    """Append ids from 1 that are unique and growing but not dense; costs no shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(1))
