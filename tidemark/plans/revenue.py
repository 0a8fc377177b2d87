"""Revenue reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import revenue
from tidemark.plans.registry import query
from tidemark.plans.tables import BILLED, MONTH, retail_items, retail_orders
from tidemark.sources.catalog import named_views

DAILY_REVENUE_SQL = """
SELECT CAST(o_orderdate AS DATE) AS order_date, round(sum(l_extendedprice), 2) AS daily_revenue
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderstatus IN ('F', 'O')
GROUP BY 1
"""

MONTH_SQL = """
SELECT CAST(o_orderdate AS DATE) AS order_date, round(sum(l_extendedprice), 2) AS daily_revenue
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderstatus IN ('F', 'O') AND strftime(o_orderdate, '%Y%m') = '199701'
GROUP BY 1
"""

PRODUCT_SQL = """
SELECT CAST(o_orderdate AS DATE) AS order_date, l_partkey AS order_item_product_id,
       round(sum(l_extendedprice), 2) AS daily_revenue
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderstatus IN ('F', 'O')
GROUP BY 1, 2
"""


@query(DAILY_REVENUE_SQL)
def daily_revenue(spark, sf_dir):
    """Daily revenue of billed orders, lowest first."""
    return revenue.daily_revenue(
        retail_orders(spark, sf_dir), retail_items(spark, sf_dir), statuses=BILLED
    ).orderBy("daily_revenue")


@query(MONTH_SQL)
def daily_revenue_month(spark, sf_dir):
    """Daily revenue of one month, highest first."""
    return revenue.daily_revenue(
        retail_orders(spark, sf_dir), retail_items(spark, sf_dir), statuses=BILLED, month=MONTH
    ).orderBy(F.col("daily_revenue").desc())


VIEWS = ("retail_orders", "retail_order_items")


def _views(spark, sf_dir):
    frames = (retail_orders(spark, sf_dir), retail_items(spark, sf_dir))
    return named_views(spark, **dict(zip(VIEWS, frames)))


@query(MONTH_SQL)
def sql_daily_revenue(spark, sf_dir):
    """The same as SQL over named views."""
    with _views(spark, sf_dir):
        return revenue.daily_revenue_sql(spark, *VIEWS, statuses=BILLED, month=MONTH)


@query(PRODUCT_SQL)
def daily_product_revenue(spark, sf_dir):
    """Revenue per day and product; by day, then highest first."""
    return revenue.daily_product_revenue(
        retail_orders(spark, sf_dir), retail_items(spark, sf_dir), statuses=BILLED
    ).orderBy("order_date", F.col("daily_revenue").desc())


@query(PRODUCT_SQL)
def sql_daily_product_revenue(spark, sf_dir):
    """The same as SQL over named views."""
    with _views(spark, sf_dir):
        return revenue.daily_product_revenue_sql(spark, *VIEWS, statuses=BILLED)
