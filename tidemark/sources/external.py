"""Tables outside the lake: JDBC databases and warehouse connectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcDatabase:
    """Where a database is. User and password go to ``options``; none are read from the machine."""

    url: str
    driver: str
    options: Mapping[str, str] = field(default_factory=dict)

    def table_options(self, table: str) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "dbtable": table, **self.options}


@dataclass(frozen=True)
class Ranges:
    """Split of a numeric, date or timestamp column into parallel queries.

    The bounds set the stride only; rows outside them are read by the first and the last query.
    """

    column: str
    lower: Any
    upper: Any
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_jdbc(
    spark: SparkSession,
    database: JdbcDatabase,
    table: str,
    *,
    split: Ranges | None = None,
    predicates: Sequence[str] = (),
    fetch_size: int = 10_000,
) -> DataFrame:
    """A database table, read in parallel by ``split`` or by one query per predicate.

    Predicates suit a column whose values are too uneven for equal strides; together they must
    cover every row once. With neither, a single connection reads the table: small tables only.
    """
    if predicates and split is not None:
        raise ValueError("give either predicates or a split, not both")
    if predicates:
        properties = {"driver": database.driver, "fetchsize": str(fetch_size), **database.options}
        return spark.read.jdbc(
            database.url, table, predicates=list(predicates), properties=properties
        )
    reader = spark.read.format("jdbc").options(**database.table_options(table))
    if split is not None:
        reader = reader.options(**split.options())
    return reader.option("fetchsize", fetch_size).load()


def read_warehouse(spark: SparkSession, source_format: str, **options: str) -> DataFrame:
    """A table of any connector on the class path, such as ``bigquery`` with ``table=...``."""
    return spark.read.format(source_format).options(**options).load()
