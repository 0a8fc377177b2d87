"""The driver tables, under their own names and in the roles the jobs expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import SHORT_GAP_STORE
from tidemark.sources.files import read_parquet

# Order status codes that stand for billed orders, and the month reported on.
BILLED = ("F", "O")
MONTH = "199701"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def retail_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("order_customer_id"),
        F.col("o_orderstatus").alias("order_status"),
    )


def retail_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_item_order_id"),
        F.col("l_partkey").alias("order_item_product_id"),
        F.col("l_quantity").alias("order_item_quantity"),
        F.col("l_extendedprice").alias("order_item_subtotal"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trips, with every field of the contract.

    Some rides end before they start, some codes have no label.
    """
    minutes = F.make_dt_interval(mins=F.lit(4) - F.col("l_linenumber"))
    pickup = F.col("l_shipdate").cast("timestamp")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + minutes).alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").cast("float").alias("trip_distance"),
        (F.col("l_partkey") % 360 - 180).cast("float").alias("pickup_longitude"),
        (F.col("l_suppkey") % 180 - 90).cast("float").alias("pickup_latitude"),
        F.col("l_linenumber").alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        (F.col("l_orderkey") % 360 - 180).cast("float").alias("dropoff_longitude"),
        (F.col("l_linenumber") * 10 - 35).cast("float").alias("dropoff_latitude"),
        F.col("l_linenumber").alias("payment_type"),
        F.col("l_extendedprice").cast("float").alias("fare_amount"),
        (F.col("l_discount") * 10).cast("float").alias("extra"),
        F.col("l_tax").cast("float").alias("mta_tax"),
        F.col("l_discount").cast("float").alias("tip_amount"),
        (F.col("l_tax") * 100).cast("float").alias("tolls_amount"),
        F.lit(0.3).cast("float").alias("improvement_surcharge"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).cast("float").alias("total_amount"),
        pickup.alias("eventTime"),
    )


def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as store sales: the event type is the store, errors the one with the short gap."""
    is_error = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.when(is_error, F.lit(SHORT_GAP_STORE)).otherwise(F.col("event_type")).alias("Store_id"),
        F.concat(F.lit("street "), (F.col("user_id") % 7).cast("string")).alias("Store_location"),
        F.col("user_id").cast("string").alias("Product_id"),
        F.col("event_type").alias("Product_category"),
        (F.col("event_id") % 10 + 1).cast("int").alias("number_of_pieces_sold"),
        (F.col("value") / 2).cast("int").alias("buy_rate"),
        F.col("value").cast("int").alias("sell_price"),
        F.col("ts").cast("timestamp").alias("eventTime"),
    )


def zoned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with a zoned time, as watermarks need it."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def zoneless(column: str) -> Column:
    """A timestamp as the tables hold it."""
    return F.col(column).cast("timestamp_ntz").alias(column)
