"""Revenue reports over orders and order items.

Frames use the columns of ``ORDERS_SCHEMA`` and ``ORDER_ITEMS_SCHEMA``; ``order_date`` may be a
date or a timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import BILLED_STATUSES


def month_bounds(month: str) -> tuple[date, date]:
    """First day of the month ``yyyyMM`` and first day of the month after it."""
    year, number = int(month[:4]), int(month[4:])
    return date(year, number, 1), date(year + number // 12, number % 12 + 1, 1)


def in_month(column: str, month: str) -> Column:
    """True within the month ``yyyyMM``.

    A half-open range on the bare column reaches the file scan; a formatted date does not.
    """
    first, following = month_bounds(month)
    return (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(following))


def billed_orders(
    orders: DataFrame, statuses: Sequence[str] = BILLED_STATUSES, month: str | None = None
) -> DataFrame:
    """Orders that count as revenue, optionally of one month."""
    kept = orders.filter(F.col("order_status").isin(*statuses))
    if month is not None:
        kept = kept.filter(in_month("order_date", month))
    return kept.select("order_id", F.to_date("order_date").alias("order_date"))


def daily_revenue(
    orders: DataFrame,
    items: DataFrame,
    *,
    statuses: Sequence[str] = BILLED_STATUSES,
    month: str | None = None,
) -> DataFrame:
    """Revenue per day, rounded to cents: ``order_date, daily_revenue``.

    Orders are filtered and joined first, so items of other months and states are never summed and,
    where the orders left are few enough to be broadcast, never shuffled. An order with very many
    items is split by adaptive execution; sums per day start before their shuffle.
    """
    return (
        billed_orders(orders, statuses, month)
        .join(items, F.col("order_id") == F.col("order_item_order_id"), "inner")
        .groupBy("order_date")
        .agg(F.round(F.sum("order_item_subtotal"), 2).alias("daily_revenue"))
    )


def daily_product_revenue(
    orders: DataFrame, items: DataFrame, *, statuses: Sequence[str] = BILLED_STATUSES
) -> DataFrame:
    """Revenue per day and product: ``order_date, order_item_product_id, daily_revenue``."""
    return (
        billed_orders(orders, statuses)
        .join(items, F.col("order_id") == F.col("order_item_order_id"), "inner")
        .groupBy("order_date", "order_item_product_id")
        .agg(F.round(F.sum("order_item_subtotal"), 2).alias("daily_revenue"))
    )


def daily_revenue_sql(
    spark: SparkSession,
    orders_view: str,
    items_view: str,
    *,
    statuses: Sequence[str] = BILLED_STATUSES,
    month: str,
) -> DataFrame:
    """``daily_revenue`` of one month over two named views or tables, as SQL, best day first."""
    first, following = month_bounds(month)
    names = [f"status_{i}" for i in range(len(statuses))]
    return spark.sql(
        f"""
        SELECT to_date(o.order_date) AS order_date, round(sum(i.order_item_subtotal), 2) AS daily_revenue
        FROM IDENTIFIER(:orders) o
        JOIN IDENTIFIER(:items) i ON o.order_id = i.order_item_order_id
        WHERE o.order_status IN ({", ".join(":" + n for n in names)})
          AND o.order_date >= :first AND o.order_date < :following
        GROUP BY 1
        ORDER BY daily_revenue DESC
        """,
        args={
            "orders": orders_view,
            "items": items_view,
            "first": first,
            "following": following,
            **dict(zip(names, statuses)),
        },
    )


def daily_product_revenue_sql(
    spark: SparkSession,
    orders_view: str,
    items_view: str,
    *,
    statuses: Sequence[str] = BILLED_STATUSES,
) -> DataFrame:
    """``daily_product_revenue`` over two named views or tables, as SQL; by day, best first."""
    names = [f"status_{i}" for i in range(len(statuses))]
    return spark.sql(
        f"""
        SELECT to_date(o.order_date) AS order_date, i.order_item_product_id,
               round(sum(i.order_item_subtotal), 2) AS daily_revenue
        FROM IDENTIFIER(:orders) o
        JOIN IDENTIFIER(:items) i ON o.order_id = i.order_item_order_id
        WHERE o.order_status IN ({", ".join(":" + n for n in names)})
        GROUP BY 1, 2
        ORDER BY 1, 3 DESC
        """,
        args={"orders": orders_view, "items": items_view, **dict(zip(names, statuses))},
    )
