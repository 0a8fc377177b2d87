"""File round trips, SQL views, managed tables and overwrites.

Each query writes to a new place in the shared scratch folder and returns what it reads back.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from tidemark.fixed_values import DAILY_REVENUE_SCHEMA
from tidemark.operators import revenue
from tidemark.plans.registry import query
from tidemark.plans.revenue import DAILY_REVENUE_SQL, PRODUCT_SQL
from tidemark.plans.tables import BILLED, retail_items, retail_orders, table
from tidemark.session import scratch_path
from tidemark.sinks.files import overwrite_directory, write_csv, write_parquet
from tidemark.sinks.tables import copy_table, insert_into, insert_overwrite, replace_rows
from tidemark.sources.catalog import (
    create_database,
    create_table,
    drop_database,
    named_views,
    use_database,
)
from tidemark.sources.files import csv_view as name_csv
from tidemark.sources.files import in_written_order, read_csv, read_parquet

ORDERS_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
ITEMS_DDL = "l_orderkey BIGINT, l_partkey BIGINT, l_extendedprice DOUBLE"

STORED_REVENUE_SQL = f"""
SELECT order_date, CAST(CAST(daily_revenue AS FLOAT) AS DOUBLE) AS order_revenue
FROM ({DAILY_REVENUE_SQL})
"""


@query("SELECT * FROM orders")
def csv_roundtrip(spark, sf_dir):
    """CSV with a header, read back with its schema."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "orders"), path)
    return read_csv(spark, path, header=True, schema=ORDERS_DDL)


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
           c_mktsegment
    FROM customer
    """
)
def csv_untyped(spark, sf_dir):
    """CSV read back without a schema: every column is text."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "customer"), path)
    return read_csv(spark, path, header=True)


@query("SELECT * FROM lineitem")
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "lineitem"), path)
    return read_parquet(spark, path)


@contextmanager
def _csv_view(spark, rows, ddl):
    """The name of a SQL view over the rows as headerless CSV files, as long as the block lasts."""
    path, name = scratch_path(spark, "csv"), f"csv_{uuid.uuid4().hex}"
    write_csv(rows, path, header=False)
    name_csv(spark, name, ddl, path)
    try:
        yield name
    finally:
        spark.catalog.dropTempView(name)


def _orders_view(spark, sf_dir):
    return _csv_view(spark, table(spark, sf_dir, "orders"), ORDERS_DDL)


def _items_view(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return _csv_view(spark, lines, ITEMS_DDL)


@query("SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus")
def csv_view(spark, sf_dir):
    """Orders per status from a SQL view over CSV files."""
    with _orders_view(spark, sf_dir) as orders:
        return spark.sql(
            f"SELECT o_orderstatus, count(*) AS orders FROM {orders} GROUP BY o_orderstatus"
        )


@query(
    f"""
    SELECT row_number() OVER (ORDER BY order_date, daily_revenue DESC, order_item_product_id) - 1
           AS place, *
    FROM ({PRODUCT_SQL})
    """
)
def insert_overwrite_dir(spark, sf_dir):
    """Daily product revenue from CSV views into a directory that held an older result, and its order there."""
    path = scratch_path(spark, "report")
    with _orders_view(spark, sf_dir) as orders, _items_view(spark, sf_dir) as items:
        report = f"""
            SELECT to_date(o_orderdate) AS order_date, l_partkey AS order_item_product_id,
                   round(sum(l_extendedprice), 2) AS daily_revenue
            FROM {orders} JOIN {items} ON o_orderkey = l_orderkey
            WHERE o_orderstatus IN {BILLED}
            GROUP BY 1, 2
            ORDER BY 1, 3 DESC, 2
            """
        write_csv(spark.table(orders).select("o_orderkey", "o_custkey"), path)
        overwrite_directory(spark, path, report)
    schema = "order_date DATE, order_item_product_id BIGINT, daily_revenue DOUBLE"
    return in_written_order(read_csv(spark, path, header=False, schema=schema))


def _orders_database(spark, sf_dir):
    """A new database with orders, filled from a view by a SQL insert."""
    database = f"retail_{uuid.uuid4().hex}"
    create_database(spark, database, scratch_path(spark, "warehouse"))
    create_table(spark, f"{database}.orders", "left_over STRING")
    drop_database(spark, database)  # with the table that is in the way
    create_database(spark, database, scratch_path(spark, "warehouse"))
    create_table(
        spark, f"{database}.orders", "order_id BIGINT, order_date DATE, order_status STRING"
    )
    with named_views(spark, retail_orders_v=retail_orders(spark, sf_dir)):
        insert_into(
            spark,
            f"{database}.orders",
            "SELECT order_id, CAST(order_date AS DATE), order_status FROM retail_orders_v",
        )
    return database


def _retail_database(spark, sf_dir):
    """A new database with orders and items."""
    database = _orders_database(spark, sf_dir)
    create_table(
        spark,
        f"{database}.order_items",
        "order_item_order_id BIGINT, order_item_product_id BIGINT, order_item_subtotal DOUBLE",
    )
    with named_views(spark, retail_order_items_v=retail_items(spark, sf_dir)):
        insert_into(
            spark,
            f"{database}.order_items",
            "SELECT order_item_order_id, order_item_product_id, order_item_subtotal "
            "FROM retail_order_items_v",
        )
    return database


REVENUE_QUERY = """
SELECT o.order_date, CAST(round(sum(i.order_item_subtotal), 2) AS FLOAT) AS order_revenue
FROM {database}.orders o
INNER JOIN {database}.order_items i ON o.order_id = i.order_item_order_id
WHERE o.order_status IN {statuses}
GROUP BY 1
"""


@query(DAILY_REVENUE_SQL)
def managed_table(spark, sf_dir):
    """Daily revenue from managed tables of the current database."""
    database = _retail_database(spark, sf_dir)
    before = spark.catalog.currentDatabase()
    use_database(spark, database)
    try:
        return revenue.daily_revenue(
            spark.table("orders"), spark.table("order_items"), statuses=BILLED
        )
    finally:
        use_database(spark, before)


@query(STORED_REVENUE_SQL)
def insert_overwrite_table(spark, sf_dir):
    """Daily revenue inserted into a table, then replaced by the same report."""
    database = _retail_database(spark, sf_dir)
    target = f"{database}.daily_revenue"
    create_table(spark, target, DAILY_REVENUE_SCHEMA)
    report = REVENUE_QUERY.format(database=database, statuses=BILLED)
    insert_into(spark, target, report)
    insert_overwrite(spark, target, report)
    return spark.table(target).withColumn("order_revenue", F.col("order_revenue").cast("double"))


@query(
    """
    SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderkey AS order_id,
           CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS order_status
    FROM orders
    """
)
def overwrite_self(spark, sf_dir):
    """A table replaced by a result computed from itself."""
    orders = f"{_orders_database(spark, sf_dir)}.orders"
    status = F.when(F.col("order_status") == "P", "O").otherwise(F.col("order_status"))
    replace_rows(spark.table(orders).withColumn("order_status", status), orders)
    return spark.table(orders)


@query(
    """
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
           CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS order_status
    FROM orders
    """
)
def table_copy(spark, sf_dir):
    """A copy of a table, made again after the table has changed."""
    database = _orders_database(spark, sf_dir)
    orders, copied = f"{database}.orders", f"{database}.orders_copied"
    copy_table(spark, orders, copied)
    status = F.when(F.col("order_status") == "P", "O").otherwise(F.col("order_status"))
    replace_rows(spark.table(orders).withColumn("order_status", status), orders)
    copy_table(spark, orders, copied)
    return spark.table(copied)
