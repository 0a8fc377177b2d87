"""Revenue, words, column functions and the plans of the larger jobs."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.fixed_values import ORDER_ITEMS_SCHEMA, ORDERS_SCHEMA
from tidemark.functions import columns as fn
from tidemark.functions.hashing import change_hash
from tidemark.operators import revenue
from tidemark.operators.words import rarest_first, split_words, word_counts
from tidemark.plans.tables import BILLED, retail_items, retail_orders

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def orders(spark):
    day, other = date(2014, 1, 31), date(2014, 2, 1)
    return spark.createDataFrame(
        [
            (1, day, 7, "COMPLETE"), (2, day, 7, "CLOSED"), (3, day, 7, "PENDING"),
            (4, other, 7, "CLOSED"), (5, other, 7, "CLOSED"),
        ],
        ORDERS_SCHEMA,
    )


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [
            (1, 1, 10, 1, 1.25, 1.25), (2, 1, 11, 1, 2.5, 2.5), (3, 2, 10, 1, 4.0, 4.0),
            (4, 3, 10, 1, 100.0, 100.0), (5, 4, 10, 2, 8.5, 4.25), (6, 99, 10, 1, 1.0, 1.0),
        ],
        ORDER_ITEMS_SCHEMA,
    )


def test_daily_revenue(orders, items):
    got = revenue.daily_revenue(orders, items)
    assert sorted(got.collect()) == [(date(2014, 1, 31), 7.75), (date(2014, 2, 1), 8.5)]


def test_month_borders(orders, items):
    got = revenue.daily_revenue(orders, items, month="201401")
    assert got.collect() == [(date(2014, 1, 31), 7.75)]
    assert revenue.month_bounds("201312") == (date(2013, 12, 1), date(2014, 1, 1))


def test_daily_revenue_in_sql(spark, orders, items):
    orders.createOrReplaceTempView("o_test")
    items.createOrReplaceTempView("i_test")
    got = revenue.daily_revenue_sql(spark, "o_test", "i_test", month="201402")
    assert got.collect() == [(date(2014, 2, 1), 8.5)]


def test_daily_product_revenue(orders, items):
    got = revenue.daily_product_revenue(orders, items)
    assert sorted(got.collect()) == [
        (date(2014, 1, 31), 10, 5.25),
        (date(2014, 1, 31), 11, 2.5),
        (date(2014, 2, 1), 10, 8.5),
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_revenue_plan_pushes_filters_and_prunes_columns(spark):
    df = revenue.daily_revenue(
        retail_orders(spark, SF_DIR), retail_items(spark, SF_DIR), statuses=BILLED, month="199701"
    )
    plan = plan_of(df)
    assert "In(o_orderstatus, [F,O])" in plan
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan


def test_month_report_shuffles_days_only(spark):
    plan = plan_of(
        revenue.daily_revenue(retail_orders(spark, SF_DIR), retail_items(spark, SF_DIR), month="199701")
    )
    # the orders of a month are broadcast, so no item is shuffled before it is summed per day
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(order_date" in plan


@pytest.fixture
def lines(spark):
    text = ["the cat sat", "the  dog", "", "a cat"]
    return spark.createDataFrame([(t,) for t in text], "value string")


def test_words_keep_empty_ones(lines):
    words = [r.word for r in split_words(lines).collect()]
    assert words == ["the", "cat", "sat", "the", "", "dog", "", "a", "cat"]


def test_word_counts_rarest_first(lines):
    got = rarest_first(word_counts(lines, containing="a")).collect()
    assert [tuple(r) for r in got] == [(1, "a"), (1, "sat"), (2, "cat")]
    assert word_counts(lines).agg(F.sum("n")).first()[0] == 9


def test_suffixes(spark):
    df = spark.createDataFrame([(1, 2)], "is_current int, a_current_b int")
    both = fn.add_suffix(df, "_current")
    assert both.columns == ["is_current_current", "a_current_b_current"]
    assert fn.strip_suffix(both, "_current").columns == df.columns
    assert fn.strip_suffix(df, "_current").columns == ["is", "a_current_b"]


def test_lookup_of_unknown_and_missing_codes(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "code int")
    got = [r[0] for r in df.select(fn.lookup("code", {1: "one"})).collect()]
    assert got == ["one", None, None]


def test_text_to_times(spark):
    df = spark.createDataFrame([("2024-01-31 10:00:00",), ("zz",), (None,)], "t string")
    got = df.select(fn.text_timestamp("t"), fn.text_date("t"), fn.epoch_timestamp("t")).collect()
    assert got[0][1] == date(2024, 1, 31)
    assert got[0][0].replace(tzinfo=None) == datetime(2024, 1, 31, 10)
    assert [r[2] for r in got] == [None] * 3
    assert tuple(got[1]) == tuple(got[2]) == (None, None, None)


def test_epoch_text(spark):
    df = spark.createDataFrame([("0",), ("86400",), ("soon",)], "t string")
    got = df.select(fn.epoch_timestamp("t").cast("long")).collect()
    assert [r[0] for r in got] == [0, 86400, None]


def test_formats(spark):
    df = spark.createDataFrame([(datetime(2014, 1, 5, 3, 4, 5),)], "t timestamp")
    assert tuple(df.select(fn.year_month("t"), fn.second_text("t")).first()) == (
        201401,
        "2014-01-05 03:04:05",
    )


def test_profit(spark):
    df = spark.createDataFrame([(66, 39, 8), (10, 12, 3)], "sell int, buy int, n int")
    assert [r[0] for r in df.select(fn.profit("sell", "buy", "n")).collect()] == [216, -6]


def test_change_hash(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "b", 1)], "x string, y string, n int")
    got = df.select(change_hash(["x", "y", "n"]), F.md5(F.lit("a_1")), F.md5(F.lit("a_b_1")))
    first, second = got.collect()
    assert first[0] == first[1] and second[0] == second[2]
    assert len({r[0] for r in df.select(change_hash([])).collect()}) == 1
