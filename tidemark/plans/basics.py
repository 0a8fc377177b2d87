"""Projections, predicates, scalar functions, order, sets, words and numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as fn
from tidemark.functions.hashing import add_change_hash
from tidemark.operators.numbering import number_rows
from tidemark.operators.words import rarest_first, word_counts
from tidemark.plans.registry import query
from tidemark.plans.tables import table, zoneless
from tidemark.session import scratch_path
from tidemark.sinks.files import write_lines
from tidemark.sources.files import read_lines, rows

STATUS_LABELS = {"F": "finished", "O": "open"}


@query("SELECT c_custkey, c_name FROM customer")
def project_cols(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def drop_col(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("c_mktsegment")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@query(
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_orderstatus IN ('F', 'O')
    """
)
def filter_text(spark, sf_dir):
    """A predicate given as SQL text."""
    urgent = "o_orderpriority = '1-URGENT' AND o_orderstatus IN ('F', 'O')"
    return table(spark, sf_dir, "orders").filter(urgent).select("o_orderkey", "o_orderstatus")


@query("SELECT c_custkey, c_name, upper(c_name) AS upper_name FROM customer")
def upper_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customers.withColumn("upper_name", F.upper("c_name"))


@query(
    """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS order_month FROM orders
    """
)
def order_month(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.year_month("o_orderdate").alias("order_month")
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events")
def date_fmt(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fn.second_text("ts").alias("ts_text"))


@query(
    """
    SELECT event_id, date_trunc('second', ts) AS parsed_ts, CAST(ts AS DATE) AS parsed_date,
           CAST(NULL AS TIMESTAMP) AS bad_ts, CAST(NULL AS DATE) AS bad_date
    FROM events
    """
)
def ts_parse(spark, sf_dir):
    """Text to timestamp and date; text that is neither gives NULL."""
    text = table(spark, sf_dir, "events").select(
        "event_id", "event_type", fn.second_text("ts").alias("ts_text")
    )
    return text.select(
        "event_id",
        fn.text_timestamp("ts_text").cast("timestamp_ntz").alias("parsed_ts"),
        fn.text_date("ts_text").alias("parsed_date"),
        fn.text_timestamp("event_type").cast("timestamp_ntz").alias("bad_ts"),
        fn.text_date("event_type").alias("bad_date"),
    )


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """
)
def top_n(spark, sf_dir):
    """The ten dearest orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(
    """
    SELECT c_nationkey AS nation, c_name AS name FROM customer
    UNION ALL
    SELECT s_nationkey AS nation, s_name AS name FROM supplier
    """
)
def union_by_name(spark, sf_dir):
    """Columns are matched by name, not by place."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return customers.unionByName(suppliers)


@query(
    """
    SELECT c_custkey AS c_custkey_history, c_name AS c_name_history,
           c_nationkey AS c_nationkey_history, c_acctbal AS c_acctbal_history,
           c_mktsegment AS c_mktsegment_history
    FROM customer
    """
)
def suffix_rename(spark, sf_dir):
    return fn.add_suffix(table(spark, sf_dir, "customer"), "_history")


@query("SELECT * FROM customer")
def suffix_strip(spark, sf_dir):
    return fn.strip_suffix(suffix_rename(spark, sf_dir), "_history")


@query(
    """
    SELECT l_orderkey, l_linenumber, (l_extendedprice - l_discount) * l_quantity AS profit
    FROM lineitem
    """
)
def profit(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.profit("l_extendedprice", "l_discount", "l_quantity").alias("profit"),
    )


@query(
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS label,
           count(*) AS orders
    FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1
    """
)
def src_rows(spark, sf_dir):
    """A table of literal rows, joined to the orders."""
    labels = rows(spark, STATUS_LABELS.items(), "status string, label string")
    orders = table(spark, sf_dir, "orders").select("o_orderstatus")
    counted = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return counted.join(labels, F.col("o_orderstatus") == F.col("status")).select("label", "orders")


@query(
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS label
    FROM orders
    """
)
def code_lookup(spark, sf_dir):
    """Codes to labels; a code without a label gives NULL."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.lookup("o_orderstatus", STATUS_LABELS).alias("label")
    )


@query("SELECT count(*) AS n FROM lineitem")
def count_all(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT coalesce(max(o_orderkey), 0) AS max_key FROM orders")
def global_max(spark, sf_dir):
    highest = F.coalesce(F.max("o_orderkey"), F.lit(0))
    return table(spark, sf_dir, "orders").agg(highest.alias("max_key"))


@query(
    """
    SELECT c_custkey, c_name,
           md5(concat_ws('_', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR))) AS hash_md5
    FROM customer
    """
)
def change_hash(spark, sf_dir):
    hashed = add_change_hash(
        table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment", "c_nationkey"]
    )
    return hashed.select("c_custkey", "c_name", "hash_md5")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_number FROM orders")
def global_row_number(spark, sf_dir):
    return number_rows(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query(
    """
    SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) + 1000 AS sk_customer
    FROM customer
    """
)
def surrogate_key(spark, sf_dir):
    """Surrogate keys in key order, above the highest key in use (1000)."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return number_rows(customers, ["c_custkey"], name="sk_customer", start=1001)


WORDS_SQL = """
SELECT count(*) AS n, word
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
{where}
GROUP BY word
"""


@query(WORDS_SQL.format(where="WHERE contains(word, 'a')"))
def word_count(spark, sf_dir):
    """Words of all documents that contain an "a", rarest first."""
    return rarest_first(word_counts(table(spark, sf_dir, "documents"), "text", containing="a"))


@query(WORDS_SQL.format(where=""))
def word_count_all(spark, sf_dir):
    return rarest_first(word_counts(table(spark, sf_dir, "documents"), "text"))


@query(
    r"""
    SELECT count(*) AS n, word
    FROM (SELECT unnest(string_split(line, ' ')) AS word
          FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM documents))
    WHERE contains(word, 'a')
    GROUP BY word
    """
)
def line_word_count(spark, sf_dir):
    """The word count over text files, line by line."""
    path = scratch_path(spark, "lines")
    write_lines(table(spark, sf_dir, "documents").select("text"), path)
    return rarest_first(word_counts(read_lines(spark, path), containing="a"))


@query("SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def json_parse(spark, sf_dir):
    """JSON text in a binary message to typed columns."""
    messages = table(spark, sf_dir, "events").select(
        "event_id", F.col("props").cast("binary").alias("value")
    )
    parsed = messages.selectExpr("event_id", "CAST(value AS STRING) AS value")
    return parsed.select("event_id", F.from_json("value", "k BIGINT").alias("s")).select(
        "event_id", "s.*"
    )


@query("SELECT event_id, date_trunc('second', ts) AS event_time FROM events")
def epoch_parse(spark, sf_dir):
    """Epoch seconds in text to timestamp."""
    events = table(spark, sf_dir, "events")
    epochs = events.select(
        "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string").alias("epoch")
    )
    return epochs.select("event_id", fn.epoch_timestamp("epoch").alias("event_time")).select(
        "event_id", zoneless("event_time")
    )
