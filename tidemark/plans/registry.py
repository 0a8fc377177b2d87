"""Registered queries: a name, a callable, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import MERGE_SESSIONS_EARLY, settings

Query = Callable[[SparkSession, str], DataFrame]

#: While a query is made up: streams run meanwhile, and the zone is fixed in the plan of its result.
SETTINGS = {
    # The tables hold zoneless UTC times; streams and epochs need zoned ones.
    "spark.sql.session.timeZone": "UTC",
    # One event type may hold most events: merge its sessions before the shuffle.
    MERGE_SESSIONS_EARLY: "true",
}

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its oracle SQL if there is one."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with settings(spark, SETTINGS):
                return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register
