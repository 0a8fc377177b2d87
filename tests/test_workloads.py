"""The five workloads end to end, with the column names and types of their contracts."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.fixed_values import (
    DAILY_REVENUE_SCHEMA,
    ORDER_ITEMS_SCHEMA,
    ORDERS_SCHEMA,
    STORE_SALE_SCHEMA,
)
from tidemark.functions.columns import profit
from tidemark.operators.revenue import daily_product_revenue, daily_revenue
from tidemark.operators.scd2 import Dimension, HistoryError
from tidemark.operators.words import rarest_first, word_counts
from tidemark.sinks import files as out
from tidemark.sinks import tables
from tidemark.sinks.external import finish_external, give_up_external, merge_external, write_warehouse
from tidemark.sources import catalog
from tidemark.sources.external import read_warehouse
from tidemark.sources.files import csv_view, read_csv, read_lines
from tidemark.sources.messages import read_message_files
from tidemark.streaming.parse import parse_store_sales, parse_trips
from tidemark.streaming.publish import publish_files, store_sale_messages, trip_messages
from tidemark.streaming.sinks import (
    committed,
    for_each_batch,
    latest_result,
    read_latest,
    to_files,
    warehouse_append,
)
from tidemark.streaming.trips import enrich_trips
from tidemark.streaming.windows import session_counts, store_gap, window_counts


def lines(spark, path, text):
    """A text file with the given lines."""
    folder = path()
    df = spark.createDataFrame([(t,) for t in text], "value string")
    out.write_lines(df.coalesce(1), folder)
    return folder


# Retail revenue --------------------------------------------------------------------------------

ORDERS = ["1,2014-01-30,7,COMPLETE", "2,2014-01-31,8,CLOSED", "3,2014-01-31,8,PENDING",
          "4,2014-02-01,9,CLOSED"]
ITEMS = ["1,1,957,1,299.98,299.98", "2,2,1073,1,199.99,199.99", "3,2,502,5,250.0,50.0",
         "4,3,403,1,129.99,129.99", "5,4,957,2,599.96,299.98"]


@pytest.fixture
def retail(spark, path):
    return lines(spark, path, ORDERS), lines(spark, path, ITEMS)


def test_revenue_from_csv(spark, retail):
    orders = read_csv(spark, retail[0], header=False, schema=ORDERS_SCHEMA)
    items = read_csv(spark, retail[1], header=False, schema=ORDER_ITEMS_SCHEMA)
    january = daily_revenue(orders, items, month="201401").orderBy(F.desc("daily_revenue"))
    assert january.collect() == [(date(2014, 1, 31), 449.99), (date(2014, 1, 30), 299.98)]
    assert daily_product_revenue(orders, items).count() == 4


def test_revenue_from_sql_views_to_a_directory(spark, path, retail):
    text_date = ORDERS_SCHEMA.replace("order_date DATE", "order_date STRING")
    csv_view(spark, "orders_csv", text_date, retail[0])
    csv_view(spark, "order_items_csv", ORDER_ITEMS_SCHEMA, retail[1])
    folder = path()
    out.overwrite_directory(
        spark,
        folder,
        """
        SELECT o.order_date, i.order_item_product_id,
               round(sum(i.order_item_subtotal), 2) AS daily_revenue
        FROM orders_csv o INNER JOIN order_items_csv i ON o.order_id = i.order_item_order_id
        WHERE o.order_status IN ('COMPLETE', 'CLOSED')
        GROUP BY o.order_date, i.order_item_product_id
        """,
    )
    written = read_csv(spark, folder, header=False, schema="d STRING, product INT, revenue DOUBLE")
    assert sorted(written.collect()) == [
        ("2014-01-30", 957, 299.98),
        ("2014-01-31", 502, 250.0),
        ("2014-01-31", 1073, 199.99),
        ("2014-02-01", 957, 599.96),
    ]


def test_revenue_in_managed_tables(spark, database, retail):
    csv_view(spark, "orders_v", ORDERS_SCHEMA, retail[0])
    csv_view(spark, "order_items_v", ORDER_ITEMS_SCHEMA, retail[1])
    orders, items = f"{database}.orders", f"{database}.order_items"
    catalog.create_table(spark, orders, ORDERS_SCHEMA)
    catalog.create_table(spark, items, ORDER_ITEMS_SCHEMA)
    tables.insert_into(spark, orders, "SELECT * FROM orders_v")
    tables.insert_into(spark, items, "SELECT * FROM order_items_v")
    target = f"{database}.daily_revenue"
    catalog.create_table(spark, target, DAILY_REVENUE_SCHEMA)
    daily_revenue(spark.table(orders), spark.table(items)).createOrReplaceTempView("report")
    query = "SELECT order_date, CAST(daily_revenue AS FLOAT) FROM report"
    tables.insert_into(spark, target, query)
    tables.insert_overwrite(spark, target, query)
    assert spark.table(target).count() == 3


# Type-2 customers ------------------------------------------------------------------------------

CUSTOMERS = (
    "CustomerID INT, Title STRING, first_name STRING, company_name STRING, email STRING, "
    "phone STRING, zip_code STRING"
)
CRM = Dimension(
    key="customerid",  # names are matched without case
    surrogate="sk_customer_id",
    tracked=("company_name", "email", "phone", "zip_code"),
)


def customers(spark, *rows):
    return spark.createDataFrame(
        [(k, "Ms", "Ann", company, "a@x", "+1", "10") for k, company in rows], CUSTOMERS
    )


def test_history_in_a_warehouse_with_a_synced_copy(spark, path):
    history, copy = path(), path()

    def to(folder):
        return lambda df: write_warehouse(df, "orc", path=folder)

    first = datetime(2024, 1, 1, tzinfo=timezone.utc)
    second = datetime(2024, 1, 2, tzinfo=timezone.utc)
    def held():
        return read_warehouse(spark, "orc", path=history)

    record = path()
    source = customers(spark, (1, "A"), (2, "B"))
    merge_external(source, lambda: None, CRM, to(history), to(copy), record=record, as_of=first)
    source = customers(spark, (1, "A2"), (3, "C"))
    merge_external(source, held, CRM, to(history), to(copy), record=record, as_of=second)

    for folder in (history, copy):
        got = read_warehouse(spark, "orc", path=folder)
        rows = got.select("CustomerID", "company_name", "sk_customer_id", "is_current").collect()
        assert sorted(rows, key=lambda r: r.sk_customer_id) == [
            (1, "A", 1, False), (2, "B", 2, False), (3, "C", 3, True), (1, "A2", 4, True)
        ]
    assert got.columns[-4:] == ["sk_customer_id", "effective_date", "expiration_date", "is_current"]


@pytest.mark.parametrize("dies_in", [0, 1])
def test_external_merge_that_died_is_brought_to_its_end(spark, path, dies_in):
    """Death within a write that has emptied its table: nothing is lost, and the history is read whole."""
    folders, record, dead = (path(), path()), path(), []
    first = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def to(number):
        def write(df):
            if not dead and number == dies_in and days:
                dead.append(number)
                write_warehouse(df.limit(1), "orc", path=folders[number])  # a part, then the end
                raise RuntimeError("driver lost")
            write_warehouse(df, "orc", path=folders[number])

        return write

    def held():
        return read_warehouse(spark, "orc", path=folders[0])

    days = []
    writes = (to(0), to(1))
    merge_external(customers(spark, (1, "A"), (2, "B")), lambda: None, CRM, *writes, record=record, as_of=first)
    days.append(2)
    second = customers(spark, (1, "A2"), (3, "C"))
    with pytest.raises(RuntimeError):
        merge_external(second, held, CRM, *writes, record=record, as_of=datetime(2024, 1, 2, tzinfo=timezone.utc))
    if dies_in:
        with pytest.raises(HistoryError, match="1 tables"):
            give_up_external(spark, record)
    third = customers(spark, (1, "A3"), (3, "C"))
    merge_external(third, held, CRM, *writes, record=record, as_of=datetime(2024, 1, 3, tzinfo=timezone.utc))
    assert not finish_external(spark, record, *writes)
    for folder in folders:
        rows = read_warehouse(spark, "orc", path=folder)
        shown = rows.select("CustomerID", "company_name", "sk_customer_id", "is_current").collect()
        assert sorted(shown, key=lambda r: r.sk_customer_id) == [
            (1, "A", 1, False), (2, "B", 2, False), (3, "C", 3, True), (1, "A2", 4, False), (1, "A3", 5, True)
        ]


def test_external_merge_rolled_back(spark, path):
    record, folder = path(), path()

    def lost(_):
        raise RuntimeError("driver lost")

    source = customers(spark, (1, "A"))
    with pytest.raises(RuntimeError):
        merge_external(source, lambda: None, CRM, lost, record=record)
    give_up_external(spark, record)
    write = lambda df: write_warehouse(df, "orc", path=folder)
    merge_external(customers(spark, (2, "B")), lambda: None, CRM, write, record=record)
    assert [r.CustomerID for r in read_warehouse(spark, "orc", path=folder).collect()] == [2]


# Trip stream -----------------------------------------------------------------------------------


def test_trip_stream_into_a_warehouse(spark, path):
    folder = lines(
        spark,
        path,
        [
            "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,trip_distance,RatecodeID,"
            "payment_type",
            "1,2024-05-06 08:10:00,2024-05-06 08:20:00,4.0,1,1",
            "2,2024-05-06 09:00:00,2024-05-06 09:00:00,12.75,3,9",
        ],
    )
    topic, sink, attempts, checkpoint = path(), path(), path(), path()
    publish_files(trip_messages(read_csv(spark, folder, header=True)), topic)
    for _ in range(2):  # the second run finds nothing new
        trips = enrich_trips(parse_trips(read_message_files(spark, topic)))
        write = warehouse_append("parquet", attempts, path=sink)
        for_each_batch(trips, write, checkpoint).awaitTermination()
    got = committed(read_warehouse(spark, "parquet", path=sink), attempts)
    shown = got.select("VendorID", "total_ride_time", "total_speed", "payment_type_name",
                       "RateCode_name").collect()
    assert sorted(shown) == [
        (1, 600, 24.0, "Credit card", "Standard rate"),
        (2, None, None, None, "Newark"),
    ]


# Store windows ---------------------------------------------------------------------------------


def test_store_windows(spark, path):
    sold = [
        ("STR_1", "10:00:00", 3, 20, 35),
        ("STR_1", "10:01:30", 5, 11, 24),
        ("STR_5", "10:00:00", 2, 50, 80),
        ("STR_5", "10:00:30", 7, 30, 42),
    ]
    sales = spark.createDataFrame(
        sold,
        "Store_id string, clock string, number_of_pieces_sold int, buy_rate int, sell_price int",
    ).withColumn("eventTime", F.concat(F.lit("2024-01-01 "), "clock").cast("timestamp"))
    topic = path()
    publish_files(store_sale_messages(sales), topic)
    stream = parse_store_sales(read_message_files(spark, topic))
    assert stream.columns == [f.split(" ")[0] for f in STORE_SALE_SCHEMA.split(", ")]

    per_store = {"keys": ["Store_id"]}
    time = ("eventTime", "Store_id")
    windows = {
        "tumbling": window_counts(stream, *time, "1 minute", watermark="1 minute"),
        "sliding": window_counts(
            stream, *time, "2 minutes", slide="1 minute", watermark="30 seconds", **per_store
        ),
        "session": session_counts(stream, *time, "1 minute", watermark="1 minute", **per_store),
        "row gap": session_counts(stream, *time, store_gap(), watermark="5 minutes", **per_store),
    }
    counted = {}
    for name, counts in windows.items():
        sink = path()
        for_each_batch(counts, latest_result(sink), path(), mode="complete").awaitTermination()
        schema = ", ".join(f"{column} {kind}" for column, kind in counts.dtypes)
        rows = read_latest(spark, sink, schema).collect()
        counted[name] = sorted(r.total_counts for r in rows)
    assert counted == {
        "tumbling": [1, 3],
        "sliding": [1, 1, 2, 2, 2],
        "session": [1, 1, 2],
        "row gap": [1, 1, 2],
    }

    sink = path()
    margin = profit("sell_price", "buy_rate", "number_of_pieces_sold").alias("profit")
    to_files(stream.select("Store_id", margin), sink, path()).awaitTermination()
    got = spark.read.parquet(sink).groupBy("Store_id").sum("profit").collect()
    assert sorted(map(tuple, got)) == [("STR_1", 45 + 65), ("STR_5", 60 + 84)]


# Word count ------------------------------------------------------------------------------------


def test_word_count_of_text_files(spark, path):
    folder = lines(spark, path, ["a path near an orchard", "bread and tea", "orchard"])
    got = rarest_first(word_counts(read_lines(spark, folder), containing="a")).collect()
    assert [tuple(r) for r in got] == [
        *((1, word) for word in ("a", "an", "and", "bread", "near", "path", "tea")),
        (2, "orchard"),
    ]
