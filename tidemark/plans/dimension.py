"""The type-2 dimension over customers.

The source has gained the customers of one segment and lost those of one nation since the history
was written; customers of three nations changed segment (tracked), and every balance rose
(untracked). Customers with a debt were closed earlier and return.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark.operators import scd2
from tidemark.operators.scd2 import Dimension
from tidemark.plans.registry import query
from tidemark.plans.tables import table, zoneless
from tidemark.session import scratch_path
from tidemark.sinks.tables import CLOSED_IN, KEY_BUCKET, copy_table, merge_table, save_history
from tidemark.sources.catalog import create_database

DIM = Dimension(key="c_custkey", surrogate="sk_customer", tracked=("c_name", "c_mktsegment"))
AS_OF = datetime(2024, 1, 1, tzinfo=timezone.utc)
BUCKETS = 8  # of a small table

FRAMES_SQL = """
WITH history AS (
    SELECT *, c_custkey + 1 AS sk_customer, TIMESTAMP '2020-01-01 00:00:00' AS effective_date,
           CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2022-06-30 00:00:00'
                ELSE TIMESTAMP '9999-12-31 23:59:59' END AS expiration_date,
           c_acctbal >= 0 AS is_current
    FROM customer WHERE c_mktsegment <> 'BUILDING'),
source AS (
    SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal,
           CASE WHEN c_nationkey IN (1, 2, 3) THEN 'RELOCATED' ELSE c_mktsegment END AS c_mktsegment
    FROM customer WHERE c_nationkey <> 7),
opened AS (SELECT * FROM history WHERE is_current),
actions AS (
    SELECT coalesce(c.c_custkey, h.c_custkey) AS c_custkey,
           CASE WHEN c.c_custkey IS NULL THEN 'DELETE'
                WHEN h.c_custkey IS NULL THEN 'INSERT'
                WHEN h.c_name IS NOT DISTINCT FROM c.c_name
                     AND h.c_mktsegment IS NOT DISTINCT FROM c.c_mktsegment THEN 'NOCHANGE'
                ELSE 'UPDATE' END AS action
    FROM opened h FULL OUTER JOIN source c ON h.c_custkey = c.c_custkey),
keys AS (
    SELECT c_custkey, row_number() OVER (ORDER BY action, c_custkey)
           + (SELECT max(sk_customer) FROM history) AS sk_customer
    FROM actions WHERE action IN ('INSERT', 'UPDATE')),
kept AS (
    SELECT h.* FROM opened h JOIN actions USING (c_custkey) WHERE action = 'NOCHANGE'),
ended AS (
    SELECT h.* REPLACE (TIMESTAMP '2024-01-01 00:00:00' AS expiration_date, FALSE AS is_current),
           action
    FROM opened h JOIN actions USING (c_custkey) WHERE action IN ('DELETE', 'UPDATE')),
started AS (
    SELECT c.*, sk_customer, TIMESTAMP '2024-01-01 00:00:00' AS effective_date,
           TIMESTAMP '9999-12-31 23:59:59' AS expiration_date, TRUE AS is_current, action
    FROM source c JOIN keys USING (c_custkey) JOIN actions USING (c_custkey))
"""

NEXT_SQL = (
    FRAMES_SQL
    + """
SELECT * FROM history WHERE NOT is_current
UNION ALL BY NAME SELECT * FROM kept
UNION ALL BY NAME SELECT * EXCLUDE (action) FROM ended
UNION ALL BY NAME SELECT * EXCLUDE (action) FROM started
"""
)

INITIAL_SQL = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       row_number() OVER (ORDER BY c_custkey) AS sk_customer,
       TIMESTAMP '2024-01-01 00:00:00' AS effective_date,
       TIMESTAMP '9999-12-31 23:59:59' AS expiration_date, TRUE AS is_current
FROM customer
"""


def history_frame(spark, sf_dir):
    in_debt = F.col("c_acctbal") < 0
    return (
        table(spark, sf_dir, "customer")
        .filter("c_mktsegment <> 'BUILDING'")
        .withColumns(
            {
                "sk_customer": F.col("c_custkey") + 1,
                "effective_date": F.lit("2020-01-01 00:00:00").cast("timestamp"),
                "expiration_date": F.when(in_debt, F.lit("2022-06-30 00:00:00"))
                .otherwise(F.lit("9999-12-31 23:59:59"))
                .cast("timestamp"),
                "is_current": ~in_debt,
            }
        )
    )


def source_frame(spark, sf_dir):
    moved = F.col("c_nationkey").isin(1, 2, 3)
    return (
        table(spark, sf_dir, "customer")
        .filter("c_nationkey <> 7")
        .withColumn("c_acctbal", F.col("c_acctbal") + 100)
        .withColumn(
            "c_mktsegment", F.when(moved, F.lit("RELOCATED")).otherwise(F.col("c_mktsegment"))
        )
    )


def _shown(history):
    """Zoneless times, as the tables have them."""
    times = ("effective_date", "expiration_date")
    return history.select(*[zoneless(c) if c in times else c for c in history.columns])


def _rows_of(spark, sf_dir, action):
    """The rows that follow from one action."""
    history, source = history_frame(spark, sf_dir), source_frame(spark, sf_dir)
    if action in (scd2.NOCHANGE, scd2.DELETE):  # add no rows, so nothing is numbered
        opened, _ = scd2.split_history(history)
        changes = scd2.find_changes(opened, source, DIM)
        versions = scd2.carried_versions(opened, changes, DIM, AS_OF)
    else:
        versions = scd2.scd2_versions(history, source, DIM, as_of=AS_OF)
    return _shown(versions.filter(F.col(scd2.ACTION) == action).drop(scd2.ACTION))


@query(FRAMES_SQL + "SELECT is_current, count(*) AS rows FROM history GROUP BY is_current")
def scd2_split(spark, sf_dir):
    """Open and closed rows of the history, counted."""
    opened, closed = scd2.split_history(history_frame(spark, sf_dir))
    return opened.unionByName(closed).groupBy("is_current").agg(F.count(F.lit(1)).alias("rows"))


@query(FRAMES_SQL + "SELECT c_custkey, action FROM actions")
def scd2_classify(spark, sf_dir):
    opened, _ = scd2.split_history(history_frame(spark, sf_dir))
    actions = scd2.classify(opened, source_frame(spark, sf_dir), DIM)
    return actions.select(
        F.col("key").alias("c_custkey"), F.col(scd2.ACTION).alias("action")
    )


@query(FRAMES_SQL + "SELECT * FROM kept")
def scd2_nochange(spark, sf_dir):
    return _rows_of(spark, sf_dir, scd2.NOCHANGE)


@query(FRAMES_SQL + "SELECT * EXCLUDE (action) FROM started WHERE action = 'INSERT'")
def scd2_insert(spark, sf_dir):
    return _rows_of(spark, sf_dir, scd2.INSERT)


@query(FRAMES_SQL + "SELECT * EXCLUDE (action) FROM ended WHERE action = 'DELETE'")
def scd2_delete(spark, sf_dir):
    return _rows_of(spark, sf_dir, scd2.DELETE)


@query(
    FRAMES_SQL
    + """
    SELECT * EXCLUDE (action) FROM ended WHERE action = 'UPDATE'
    UNION ALL BY NAME SELECT * EXCLUDE (action) FROM started WHERE action = 'UPDATE'
    """
)
def scd2_update(spark, sf_dir):
    return _rows_of(spark, sf_dir, scd2.UPDATE)


@query(NEXT_SQL)
def scd2_full(spark, sf_dir):
    """The whole next history."""
    return _shown(
        scd2.scd2_merge(
            history_frame(spark, sf_dir), source_frame(spark, sf_dir), DIM, as_of=AS_OF
        )
    )


@query(
    f"""
    SELECT * REPLACE (CAST(effective_date AS DATE) AS effective_date,
                      CAST(expiration_date AS DATE) AS expiration_date)
    FROM ({NEXT_SQL})
    """
)
def scd2_by_day(spark, sf_dir):
    """The next history of a dimension that is kept by day."""
    times = {c: F.to_date(c) for c in ("effective_date", "expiration_date")}
    history = history_frame(spark, sf_dir).withColumns(times)
    dim = replace(DIM, time_type="date")
    return scd2.scd2_merge(history, source_frame(spark, sf_dir), dim, as_of=AS_OF)


def _new_database(spark):
    name = f"tidemark_{uuid.uuid4().hex}"
    create_database(spark, name, scratch_path(spark, "warehouse"))
    return name


def _history_of(spark, history):
    """The rows of a history table, without its layout."""
    return _shown(spark.table(history).drop(CLOSED_IN, KEY_BUCKET))


@query(INITIAL_SQL)
def scd2_initial(spark, sf_dir):
    """The first load of a history table that does not exist yet."""
    history = f"{_new_database(spark)}.customer_history"
    merge_table(table(spark, sf_dir, "customer"), history, DIM, as_of=AS_OF, buckets=BUCKETS)
    return _history_of(spark, history)


@query(NEXT_SQL)
def scd2_sync(spark, sf_dir):
    """The rows of a copy that missed a merge of its history, after the next one."""
    database = _new_database(spark)
    history, synced = f"{database}.customer_history", f"{database}.customer_incremental"
    save_history(history_frame(spark, sf_dir), history, DIM, buckets=BUCKETS)
    copy_table(spark, history, synced)
    source = source_frame(spark, sf_dir)
    merge_table(source, history, DIM, as_of=AS_OF)
    merge_table(source, history, DIM, as_of=AS_OF, synced=synced)
    return _history_of(spark, synced)


@query(
    f"""
    SELECT * REPLACE (
        CASE WHEN is_current AND c_nationkey = 9 THEN TIMESTAMP '2024-02-01 00:00:00'
             ELSE expiration_date END AS expiration_date,
        is_current AND c_nationkey <> 9 AS is_current)
    FROM ({NEXT_SQL.replace("ELSE TIMESTAMP '9999-12-31 23:59:59' END", "ELSE TIMESTAMP '9999-12-31 00:00:00' END")})
    """
)
def scd2_table(spark, sf_dir):
    """Two merges of a table whose open rows end at a day's start; the second source has its columns turned round."""
    database = _new_database(spark)
    history, synced = f"{database}.customer_history", f"{database}.customer_incremental"
    ends = F.when(F.col("is_current"), F.lit("9999-12-31 00:00:00").cast("timestamp"))
    rows = history_frame(spark, sf_dir).withColumn("expiration_date", F.coalesce(ends, "expiration_date"))
    save_history(rows, history, DIM, buckets=BUCKETS)
    source = source_frame(spark, sf_dir)
    merge_table(source, history, DIM, as_of=AS_OF, synced=synced)
    later = source.filter("c_nationkey <> 9").select(*reversed(source.columns))
    merge_table(later, history, DIM, as_of=AS_OF + timedelta(days=31), synced=synced)
    return _history_of(spark, synced)
