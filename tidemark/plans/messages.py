"""Message streams: publish, parse, enrich, and append per batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.fixed_values import CHUNK_SIZE
from tidemark.plans.registry import query
from tidemark.plans.tables import store_sales, table, trips, zoned_events
from tidemark.plans.windows import KEYED_COUNTS, SESSION_SQL, SLICES, run_complete
from tidemark.session import scratch_path
from tidemark.sources.files import read_parquet
from tidemark.sources.messages import read_file_stream, read_message_files
from tidemark.streaming.chunks import manifest, read_chunks
from tidemark.streaming.chunks import publish_chunks as publish_in_chunks
from tidemark.streaming.parse import parse_store_sales, parse_trips
from tidemark.streaming.publish import publish_files, store_sale_messages, trip_messages
from tidemark.streaming.batches import batch_folders, read_batches
from tidemark.streaming.sinks import for_each_batch
from tidemark.streaming.slices import run_slices, time_slices
from tidemark.streaming.trips import enrich_trips
from tidemark.streaming.windows import session_counts, store_gap

TRIP_FIELDS_SQL = """
SELECT l_linenumber AS VendorID, l_shipdate AS tpep_pickup_datetime,
       l_shipdate + (4 - l_linenumber) * INTERVAL '1 minute' AS tpep_dropoff_datetime,
       l_linenumber AS passenger_count, l_quantity AS trip_distance,
       CAST(l_partkey % 360 - 180 AS DOUBLE) AS pickup_longitude,
       CAST(l_suppkey % 180 - 90 AS DOUBLE) AS pickup_latitude,
       l_linenumber AS RatecodeID, l_returnflag AS store_and_fwd_flag,
       CAST(l_orderkey % 360 - 180 AS DOUBLE) AS dropoff_longitude,
       CAST(l_linenumber * 10 - 35 AS DOUBLE) AS dropoff_latitude,
       l_linenumber AS payment_type,
       CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS fare_amount,
       CAST(CAST(l_discount * 10 AS FLOAT) AS DOUBLE) AS extra,
       CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS mta_tax,
       CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS tip_amount,
       CAST(CAST(l_tax * 100 AS FLOAT) AS DOUBLE) AS tolls_amount,
       CAST(CAST(0.3 AS FLOAT) AS DOUBLE) AS improvement_surcharge,
       CAST(CAST(l_extendedprice * (1 + l_tax) AS FLOAT) AS DOUBLE) AS total_amount,
       l_shipdate AS eventTime
FROM lineitem
"""

TRIP_SQL = f"""
WITH fields AS ({TRIP_FIELDS_SQL}),
rides AS (
    SELECT *, CASE WHEN VendorID <> 4 THEN CAST((4 - VendorID) * 60 AS BIGINT) END
              AS total_ride_time
    FROM fields)
SELECT *, round(trip_distance / 30 * 60 * 60) AS estimated_ride_time,
       round(trip_distance / total_ride_time * 3600) AS total_speed,
       CASE VendorID WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
                     WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided tip' END
           AS payment_type_name,
       CASE VendorID WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
                     WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare'
                     WHEN 6 THEN 'Group ride' END AS RateCode_name
FROM rides
"""

SALES_SQL = """
SELECT CASE event_type WHEN 'error' THEN 'STR_5' ELSE event_type END AS Store_id,
       'street ' || user_id % 7 AS Store_location, CAST(user_id AS VARCHAR) AS Product_id,
       event_type AS Product_category, CAST(event_id % 10 + 1 AS INTEGER) AS number_of_pieces_sold,
       CAST(trunc(value / 2) AS INTEGER) AS buy_rate, CAST(trunc(value) AS INTEGER) AS sell_price, date_trunc('second', ts) AS eventTime
FROM events
"""

STORE_SESSIONS_SQL = SESSION_SQL.format(
    gap="CASE WHEN event_type = 'STR_5' THEN INTERVAL '20 seconds' ELSE INTERVAL '2 minutes' END"
).replace(
    "FROM events", f"FROM (SELECT Store_id AS event_type, eventTime AS ts FROM ({SALES_SQL}))"
)


def _trips_shown(trips):
    """Zoneless times and doubles, as the tables have them."""
    shown = {"timestamp": "timestamp_ntz", "float": "double"}
    return trips.select(
        *[F.col(name).cast(shown.get(kind, kind)).alias(name) for name, kind in trips.dtypes]
    )


@query(TRIP_SQL)
def trip_enrich(spark, sf_dir):
    """Ride time, estimate, speed and labels of every trip."""
    return _trips_shown(enrich_trips(trips(spark, sf_dir)))


@query(TRIP_FIELDS_SQL)
def publish_json(spark, sf_dir):
    """Trips to messages and back."""
    path = scratch_path(spark, "topic")
    publish_files(trip_messages(trips(spark, sf_dir)), path)
    return _trips_shown(parse_trips(read_parquet(spark, path)))


@query(SALES_SQL)
def publish_json_epoch(spark, sf_dir):
    """Store sales to messages with epoch seconds, and back."""
    path = scratch_path(spark, "topic")
    publish_files(store_sale_messages(store_sales(spark, sf_dir)), path)
    parsed = parse_store_sales(read_parquet(spark, path))
    return parsed.withColumn("eventTime", F.col("eventTime").cast("timestamp_ntz"))


EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


@query(
    f"""
    SELECT (row_number() OVER (ORDER BY event_id) - 1) // {CHUNK_SIZE} AS chunk,
           row_number() OVER (ORDER BY event_id) - 1 AS position, *
    FROM events
    """
)
def publish_chunks(spark, sf_dir):
    """Events published in order as a log of chunks, and read back from it with their positions."""
    path = scratch_path(spark, "log")
    publish_in_chunks(table(spark, sf_dir, "events"), ["event_id"], path)
    last = manifest(spark, path).agg(F.max("chunk")).first()[0]
    event = F.from_json(F.col("value").cast("string"), EVENTS).alias("event")
    rows = read_chunks(spark, path, 0, -1 if last is None else last)
    return rows.select("chunk", "position", event).select("chunk", "position", "event.*")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_foreach_batch(spark, sf_dir):
    """Events appended per batch, slice by slice; a further run on the same checkpoint adds nothing."""
    events = zoned_events(spark, sf_dir)
    topic, path = scratch_path(spark, "topic"), scratch_path(spark, "sink")
    checkpoint = scratch_path(spark, "sink-progress")

    def start():
        stream = read_file_stream(spark, topic, events.schema)
        return for_each_batch(stream, batch_folders(path), checkpoint)

    run_slices(time_slices(events, "ts", SLICES), topic, start)
    start().awaitTermination()
    stored = read_batches(spark, path, EVENTS.replace("TIMESTAMP_NTZ", "TIMESTAMP"))
    return stored.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(TRIP_SQL)
def stream_trips(spark, sf_dir):
    """Trip messages from a topic folder, parsed, enriched and appended per batch."""
    topic, path = scratch_path(spark, "topic"), scratch_path(spark, "sink")
    checkpoint = scratch_path(spark, "sink-progress")

    def enriched():
        return _trips_shown(enrich_trips(parse_trips(read_message_files(spark, topic))))

    def start():
        return for_each_batch(enriched(), batch_folders(path), checkpoint)

    sent = trips(spark, sf_dir)
    run_slices(map(trip_messages, time_slices(sent, "eventTime", SLICES)), topic, start)
    schema = ", ".join(f"{name} {kind}" for name, kind in enriched().dtypes)
    return read_batches(spark, path, schema)


@query(STORE_SESSIONS_SQL)
def stream_store_sessions(spark, sf_dir):
    """Store sale messages from a topic folder, parsed and counted per store and session."""

    def counts(topic):
        sales = parse_store_sales(read_message_files(spark, topic))
        found = session_counts(
            sales, "eventTime", "Store_id", store_gap(), keys=["Store_id"], watermark="5 minutes"
        )
        return found.withColumnRenamed("Store_id", "event_type")

    sent = time_slices(store_sales(spark, sf_dir), "eventTime", SLICES)
    return run_complete(spark, map(store_sale_messages, sent), counts, KEYED_COUNTS)
