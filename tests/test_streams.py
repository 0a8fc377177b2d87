from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.fixed_values import CHUNK_SIZE, LARGE_CHUNK_SIZE
from tidemark.sources.messages import (
    kafka_options,
    read_file_stream,
    read_messages,
)
from tidemark.session import stage
from tidemark.streaming import batches, chunks, publish, sinks, slices, windows
from tidemark.streaming.parse import parse_messages, parse_store_sales, parse_trips
from tidemark.streaming.trips import enrich_trips
from tidemark.streaming.windows import session_counts, store_gap, window_counts

EVENTS = "Store_id STRING, eventTime TIMESTAMP"
COUNTS = "total_counts BIGINT, start TIMESTAMP, end TIMESTAMP"
KEYED = f"Store_id STRING, {COUNTS}"


def messages(spark, documents):
    return spark.createDataFrame([(d.encode(),) for d in documents], "value binary")


def events(spark, rows):
    """Rows ``(store, 'HH:MM:SS')`` of one day."""
    df = spark.createDataFrame(rows, "Store_id string, clock string")
    moment = F.concat(F.lit("2024-01-01 "), "clock").cast("timestamp")
    return df.select("Store_id", moment.alias("eventTime"))


def counted(df):
    shown = df.withColumns({c: F.date_format(c, "HH:mm:ss") for c in ("start", "end")})
    return sorted(tuple(r) for r in shown.collect())


# Messages --------------------------------------------------------------------------------------


def test_malformed_message_and_field_give_nulls(spark):
    df = messages(spark, ['{"a": 1, "b": "x"}', '{"a": "one", "b": "y"}', "{broken", '{"b": null}'])
    got = parse_messages(df, "a INT, b STRING").collect()
    assert [tuple(r) for r in got] == [(1, "x"), (None, "y"), (None, None), (None, None)]


def test_store_sale_event_time(spark):
    df = messages(
        spark,
        [
            '{"Store_id": "STR_1", "sell_price": 5, "eventTime": 1704067205}',
            '{"Store_id": "STR_2", "eventTime": "soon"}',
            '{"Store_id": "STR_3"}',
        ],
    )
    got = parse_store_sales(df).select("Store_id", "sell_price", "eventTime").collect()
    shown = [(r[0], r[1], r[2] and r[2].timestamp()) for r in got]
    assert shown == [("STR_1", 5, 1704067205.0), ("STR_2", None, None), ("STR_3", None, None)]


def test_trip_features_and_labels(spark):
    template = (
        '{{"tpep_pickup_datetime": "2024-05-06 00:00:00", "tpep_dropoff_datetime": "2024-05-06 {}",'
        ' "trip_distance": {}, "payment_type": {}, "RatecodeID": {}}}'
    )
    df = messages(
        spark,
        [
            template.format("00:10:00", 4.0, 1, 1),
            template.format("00:05:00", 1.5, 2, 3),
            template.format("01:00:00", 30.0, 6, 6),
            template.format("00:00:00", 6.25, 7, 99),
            template.format("00:00:00", 12.5, "null", "null"),
        ],
    )
    got = enrich_trips(parse_trips(df)).select(
        "total_ride_time",
        "estimated_ride_time",
        "total_speed",
        "payment_type_name",
        "RateCode_name",
    )
    assert [tuple(r) for r in got.collect()] == [
        (600, 480.0, 24.0, "Credit card", "Standard rate"),
        (300, 180.0, 18.0, "Cash", "Newark"),
        (3600, 3600.0, 30.0, "Voided tip", "Group ride"),
        (None, 750.0, None, None, None),
        (None, 1500.0, None, None, None),
    ]


def test_ride_that_ends_before_it_starts(spark):
    df = messages(
        spark,
        ['{"tpep_pickup_datetime": "2016-03-01 00:02:00",'
         ' "tpep_dropoff_datetime": "2016-03-01 00:01:00", "trip_distance": 1.0}'],
    )
    row = enrich_trips(parse_trips(df)).first()
    assert (row.total_ride_time, row.total_speed) == (-60, -60.0)


def test_text_records_to_typed_messages(spark):
    df = spark.createDataFrame(
        [("1", "2016-03-01 00:00:00", "2.5", "left out"), ("x", "never", "", "")],
        "VendorID string, tpep_pickup_datetime string, trip_distance string, other string",
    )
    got = parse_trips(publish.trip_messages(df)).collect()
    assert (got[0].VendorID, got[0].trip_distance) == (1, 2.5)
    assert (got[1].VendorID, got[1].tpep_pickup_datetime, got[1].trip_distance) == (None,) * 3


def test_store_sale_time_is_sent_as_a_number(spark):
    df = events(spark, [("STR_1", "00:00:05")])
    text = publish.store_sale_messages(df).selectExpr("CAST(value AS STRING) AS v").first().v
    assert text == '{"Store_id":"STR_1","eventTime":1704067205}'


def test_connector_is_a_format_and_options(spark, path):
    """Any source with a value will do; the rate source stands in for a broker."""
    stream = read_messages(spark, "rate", rowsPerSecond="1")
    assert stream.isStreaming and stream.columns == ["value"]
    folder = path()
    publish.publish_broker(messages(spark, ["{}"]), "parquet", path=folder)
    assert [bytes(r.value) for r in spark.read.parquet(folder).collect()] == [b"{}"]


def test_kafka_options():
    assert kafka_options("host:1", "sales") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "sales",
        "startingOffsets": "latest",
    }


# Chunk logs ------------------------------------------------------------------------------------


def in_chunks(rows):
    """``{chunk: [(position, k), ...]}`` of the rows read from a log."""
    found = {}
    for row in rows.select("chunk", "position", F.from_json(F.col("value").cast("string"), "k int")["k"].alias("k")).collect():
        found.setdefault(row.chunk, []).append((row.position, row.k))
    return {chunk: sorted(held) for chunk, held in found.items()}


@pytest.mark.parametrize("size", [1, 7, 50, CHUNK_SIZE, LARGE_CHUNK_SIZE])
def test_log_holds_chunks_in_order_in_few_files(spark, path, size):
    log = path()
    records = spark.range(100).select((F.col("id") * 37 % 100).alias("k")).repartition(5)
    chunks.publish_chunks(records, ["k"], log, size)
    wanted = {}
    for k in range(100):
        wanted.setdefault(k // size, []).append((k, k))
    assert in_chunks(chunks.read_chunks(spark, log, 0, 99)) == wanted
    # files follow the ranges of the order, whatever the size of a chunk
    files = spark.read.parquet(f"{log}/messages").inputFiles()
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    for row in chunks.manifest(spark, log).groupBy("chunk").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n")).collect():
        assert row.n == len(wanted[row.chunk])
    one = chunks.read_chunks(spark, log, 1, 1)
    assert in_chunks(one) == {k: v for k, v in wanted.items() if k == 1}
    held = {r.file for r in chunks.manifest(spark, log).where("chunk = 1").collect()}
    opened = {f.rsplit("/", 1)[1] for f in one.inputFiles() if "/messages/" in f}
    assert not held or opened == {f.rsplit("/", 1)[1] for f in held}


def test_chunks_are_handed_over_in_order_and_once(spark, path):
    log, progress, seen = path(), path(), []
    chunks.publish_chunks(spark.range(25).toDF("k"), ["k"], log, 4)

    def write(rows, first):
        if first == 2 and len(seen) == 2:
            seen.append("died")
            raise RuntimeError("reader lost")
        seen.append((first, sorted(k for held in in_chunks(rows).values() for _, k in held)))

    with pytest.raises(RuntimeError):
        chunks.for_each_chunk(spark, log, write, progress)
    assert chunks.for_each_chunk(spark, log, write, progress, chunks=3) == 2
    assert chunks.for_each_chunk(spark, log, write, progress) == 0
    assert seen == [
        (0, [0, 1, 2, 3]), (1, [4, 5, 6, 7]), "died", (2, list(range(8, 20))), (5, list(range(20, 25)))
    ]


def test_log_of_no_rows_and_of_copies(spark, path):
    log = path()
    chunks.publish_chunks(spark.range(0).toDF("k"), ["k"], log, 4)
    assert chunks.read_chunks(spark, log, 0, 9).collect() == []
    assert chunks.for_each_chunk(spark, log, None, path()) == 0
    log = path()
    chunks.publish_chunks(spark.range(10).select(F.lit(3).alias("k")), ["k"], log, 4)
    assert in_chunks(chunks.read_chunks(spark, log, 0, 9)) == {
        0: [(i, 3) for i in range(4)], 1: [(i, 3) for i in range(4, 8)], 2: [(8, 3), (9, 3)]
    }


def test_messages_keep_microseconds(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00.123456' AS eventTime, TIMESTAMP_NTZ '2024-01-01 00:00:00.654321' AS n")
    text = publish.to_messages(df).selectExpr("CAST(value AS STRING) AS v").first().v
    assert text == '{"eventTime":"2024-01-01T00:00:00.123456Z","n":"2024-01-01T00:00:00.654321"}'


# Slices ----------------------------------------------------------------------------------------


def test_slices_hold_each_row_once_and_in_order(spark):
    moments = [None, 0, 1, 5, 5, 17, 99, 100, 100]
    df = spark.createDataFrame([(m,) for m in moments], "m long").select("m", F.timestamp_micros("m").alias("at"))
    found = [[r.m for r in rows.collect()] for rows in slices.time_slices(df, "at", 4)]
    assert len(found) == 4
    assert sorted((m for held in found for m in held), key=lambda m: -1 if m is None else m) == moments
    assert found[0] == [None, 0, 1, 5, 5, 17] and found[3] == [99, 100, 100]
    assert [rows.count() for rows in slices.time_slices(df.limit(0), "at", 4)] == [0]
    assert [rows.count() for rows in slices.time_slices(df.where("m = 5"), "at", 4)] == [2]


def test_closed_windows_have_left_the_state(spark, path):
    """After each slice the state holds just the windows that the watermark has not closed."""
    topic, sink, checkpoint = path(), path(), path()
    rows = [("a", f"1{h}:{m:02}:30") for h in range(6) for m in range(0, 60, 7)]
    df = events(spark, rows).coalesce(1)

    def start():
        return sinks.to_files(tumbling(read_file_stream(spark, topic, EVENTS)), sink, checkpoint)

    held = []
    for rows in slices.time_slices(df, "eventTime", 6):
        assert slices.run_slices([rows], topic, start) == 1
        watermark = rows.agg(F.max("eventTime")).first()[0] - timedelta(minutes=1)
        open_now = slices.open_windows(spark, checkpoint)
        assert open_now.columns == ["start", "end", "total_counts"]
        assert open_now.where(F.col("end") <= F.lit(watermark)).isEmpty()
        held.append(open_now.count())
    assert held == [1] * 6
    closed = spark.read.schema(COUNTS).parquet(sink)
    batch = window_counts(df, "eventTime", "Store_id", "1 minute")
    assert counted(closed.unionByName(open_now)) == counted(batch)


def test_slices_in_one_run_of_a_session_stream(spark, path):
    """Sessions over the border of two slices are one, as in a batch."""
    topic, sink, checkpoint = path(), path(), path()
    df = events(spark, [("a", f"10:{m:02}:00") for m in range(30)] + [("b", "10:00:00"), ("b", "10:29:59")])
    minute = lambda frame: session_counts(frame, "eventTime", "Store_id", "61 seconds", keys=["Store_id"], watermark="1 minute")
    batches = slices.run_slices(
        slices.time_slices(df, "eventTime", 5), topic,
        lambda: sinks.for_each_batch(minute(read_file_stream(spark, topic, EVENTS)), sinks.latest_result(sink), checkpoint, mode="complete"),
    )
    assert batches == 5
    assert counted(sinks.read_latest(spark, sink, KEYED)) == counted(minute(df))


# Sinks -----------------------------------------------------------------------------------------


def test_restarted_stream_adds_only_new_rows(spark, path):
    topic, sink, checkpoint = path(), path(), path()

    def run():
        stream = read_file_stream(spark, topic, "id BIGINT")
        sinks.for_each_batch(stream, batches.batch_folders(sink), checkpoint).awaitTermination()
        return sorted(r.id for r in batches.read_batches(spark, sink, "id BIGINT").collect())

    spark.range(5).write.parquet(topic)
    assert run() == run() == [0, 1, 2, 3, 4]
    spark.range(5, 7).write.mode("append").parquet(topic)
    assert run() == [0, 1, 2, 3, 4, 5, 6]


def test_repeated_batch_replaces_itself(spark, path):
    sink = path()
    write = batches.batch_folders(sink)
    write(spark.range(3), 0)
    write(spark.range(3, 5), 1)
    write(spark.range(3, 5), 1)
    got = batches.read_batches(spark, sink, "id BIGINT").collect()
    assert sorted(r.id for r in got) == [0, 1, 2, 3, 4]


def folders(path):
    """The folders of batches and parts of a log in a local folder."""
    import glob

    place = path.removeprefix("file:")
    return sorted(glob.glob(f"{place}/batches/*=*") + glob.glob(f"{place}/folded/*"))


def test_folded_log_holds_each_row_once_in_few_folders(spark, path):
    sink, most = path(), 0
    write = batches.batch_folders(sink)
    assert batches.fold_batches(spark, sink, "id BIGINT", fan=3) == 0
    for batch_id in range(60):
        write(spark.range(2 * batch_id, 2 * batch_id + 2).coalesce(1), batch_id)
        if batch_id % 4 == 3:
            batches.fold_batches(spark, sink, "id BIGINT", fan=3)
            most = max(most, len(folders(sink)))
            rows = batches.read_batches(spark, sink, "id BIGINT", with_ids=True).collect()
            assert sorted((r.id, r.batch_id) for r in rows) == [(i, i // 2) for i in range(2 * batch_id + 2)]
    # up to two of each of four levels, what the last fold replaced, the batches since
    assert most <= 8 + 4 + 9 + 5
    assert len(folders(sink)) < 60 / 3
    state = batches._pointer(spark, sink)
    assert max(level for _, level in state["parts"]) >= 2


def test_reader_during_a_fold_sees_each_row_once(spark, path, monkeypatch):
    sink, seen = path(), []
    write = batches.batch_folders(sink)

    def look(*_):
        seen.append(sorted(r.id for r in batches.read_batches(spark, sink, "id BIGINT").collect()))

    def between(function):
        def call(*args, **kwargs):
            look()
            function(*args, **kwargs)
            look()

        return call

    for name in ("_write", "_point", "remove_folder"):
        monkeypatch.setattr(batches, name, between(getattr(batches, name)))
    for batch_id in range(8):
        write(spark.range(batch_id, batch_id + 1), batch_id)
        if batch_id % 2:
            seen.clear()
            before = batches.read_batches(spark, sink, "id BIGINT")  # analysed before the fold, read after it
            batches.fold_batches(spark, sink, "id BIGINT", fan=2)
            look()
            assert seen and all(ids == list(range(batch_id + 1)) for ids in seen)
            assert before.count() == batch_id + 1


def test_fold_that_died_and_batch_that_is_repeated(spark, path, monkeypatch):
    sink = path()
    write = batches.batch_folders(sink)
    for batch_id in range(4):
        write(spark.range(batch_id, batch_id + 1), batch_id)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(batches, "_point", lost)
        with pytest.raises(RuntimeError):
            batches.fold_batches(spark, sink, "id BIGINT")
    ids = lambda: sorted(r.id for r in batches.read_batches(spark, sink, "id BIGINT").collect())
    assert ids() == [0, 1, 2, 3]
    write(spark.range(4, 5), 4)
    batches.fold_batches(spark, sink, "id BIGINT")
    write(spark.range(3, 4), 3)  # folded meanwhile
    write(spark.range(4, 5), 4)
    assert ids() == [0, 1, 2, 3, 4]
    batches.fold_batches(spark, sink, "id BIGINT")
    assert ids() == [0, 1, 2, 3, 4]


def test_folded_notes_of_attempts(spark, path):
    sink, attempts = path(), path()
    write = sinks.warehouse_append("parquet", attempts, path=sink)
    for batch_id in range(6):
        write(spark.range(batch_id, batch_id + 1), batch_id)
    batches.fold_batches(spark, attempts, f"{sinks.ATTEMPT} STRING")
    write(spark.range(2, 3), 2)  # noted: not written again
    assert spark.read.parquet(sink).count() == 6
    assert sorted(r.id for r in sinks.committed(spark.read.parquet(sink), attempts).collect()) == list(range(6))


def test_batches_handed_over_twice_read_back_once(spark, path):
    sink, attempts = path(), path()
    write = sinks.warehouse_append("parquet", attempts, path=sink)
    write(spark.range(2), 0)
    write(spark.range(2), 0)  # noted: not written again
    # an attempt that died after its rows were written
    sinks.warehouse_append("parquet", path(), path=sink)(spark.range(2, 3), 1)
    write(spark.range(2, 3), 1)
    rows = spark.read.parquet(sink)
    assert rows.count() == 4
    got = sinks.committed(rows, attempts).collect()
    assert sorted((r.id, r.batch_id) for r in got) == [(0, 0), (1, 0), (2, 1)]
    assert sinks.committed(rows, path()).isEmpty()


def test_latest_result_keeps_two_results(spark, path):
    sink = path()
    assert sinks.read_latest(spark, sink, "id BIGINT").isEmpty()
    write = sinks.latest_result(sink)
    for batch_id in (0, 1, 1, 2, 3):
        write(spark.range(batch_id + 1), batch_id)
        assert sinks.read_latest(spark, sink, "id BIGINT").count() == batch_id + 1
    # an unfinished result is not read
    spark.range(50).write.mode("overwrite").parquet(f"{sink}/slot={1 - sinks._published(spark, sink)['slot']}")
    assert sinks.read_latest(spark, sink, "id BIGINT").count() == 4


# Windows ---------------------------------------------------------------------------------------

LATE = [
    [("a", "10:00:10"), ("a", "10:00:50"), ("b", "10:01:10")],
    [("a", "10:30:00")],
    [("a", "10:00:30"), ("a", "10:30:30")],  # the first is long past the watermark
    [("a", "11:30:00")],
]


def run_batches(spark, path, batches, count, mode):
    """Feed one micro-batch after the other to a stream of counts; the final result."""
    topic, sink, checkpoint = path(), path(), path()
    for rows in batches:
        events(spark, rows).coalesce(1).write.mode("append").parquet(topic)
        counts = count(read_file_stream(spark, topic, EVENTS))
        if mode == "append":
            sinks.to_files(counts, sink, checkpoint).awaitTermination()
        else:
            write = sinks.latest_result(sink)
            sinks.for_each_batch(counts, write, checkpoint, mode=mode).awaitTermination()
    schema = KEYED if "Store_id" in counts.columns else COUNTS
    if mode == "append":
        return counted(spark.read.schema(schema).parquet(sink))
    return counted(sinks.read_latest(spark, sink, schema))


def tumbling(df):
    return window_counts(df, "eventTime", "Store_id", "1 minute", watermark="1 minute")


def test_append_drops_late_rows_and_shows_closed_windows(spark, path):
    assert run_batches(spark, path, LATE, tumbling, "append") == [
        (1, "10:01:00", "10:02:00"),
        (2, "10:00:00", "10:01:00"),
        (2, "10:30:00", "10:31:00"),
    ]


def test_complete_counts_late_rows_and_shows_all_windows(spark, path):
    assert run_batches(spark, path, LATE, tumbling, "complete") == [
        (1, "10:01:00", "10:02:00"),
        (1, "11:30:00", "11:31:00"),
        (2, "10:30:00", "10:31:00"),
        (3, "10:00:00", "10:01:00"),
    ]


def sliding(df):
    return window_counts(
        df, "eventTime", "Store_id", "2 minutes", slide="1 minute", keys=["Store_id"],
        watermark="30 seconds",
    )


def session(df):
    return session_counts(
        df, "eventTime", "Store_id", "1 minute", keys=["Store_id"], watermark="1 minute"
    )


def row_gap(df):
    return session_counts(
        df, "eventTime", "Store_id", store_gap(), keys=["Store_id"], watermark="5 minutes"
    )


SALES = [
    [("STR_1", "10:00:00"), ("STR_5", "10:00:00"), ("STR_5", "10:00:20"), ("STR_1", "10:01:00")],
    [("STR_1", "10:02:01"), ("STR_5", "10:00:41"), ("STR_1", "10:04:01"), (None, "10:00:00")],
    [("STR_1", "10:08:00"), ("STR_5", "10:00:30"), ("STR_2", "10:00:00")],
]


@pytest.mark.parametrize("count", [tumbling, sliding, session, row_gap])
def test_stream_equals_batch(spark, path, count):
    batch = counted(count(events(spark, [row for rows in SALES for row in rows])).na.fill("-"))
    stream = [
        tuple("-" if v is None else v for v in row)
        for row in run_batches(spark, path, SALES, lambda df: count(df).na.fill("-"), "complete")
    ]
    assert stream == batch and batch


def test_sessions_by_hand(spark):
    df = events(spark, [row for rows in SALES for row in rows])
    assert counted(row_gap(df.na.drop())) == [
        ("STR_1", 1, "10:08:00", "10:10:00"),
        ("STR_1", 4, "10:00:00", "10:06:01"),  # 10:02:01 + 2 min meets 10:04:01 exactly
        ("STR_2", 1, "10:00:00", "10:02:00"),
        ("STR_5", 4, "10:00:00", "10:01:01"),
    ]


def spark_sessions(df, gap):
    """Spark's own session windows as the reference result."""
    return (
        df.groupBy("Store_id", F.session_window("eventTime", gap).alias("w"))
        .agg(F.count("Store_id").alias("total_counts"))
        .select("Store_id", "total_counts", "w.start", "w.end")
    )


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("per_row", [False, True])
def test_batch_sessions_equal_session_windows(spark, seed, per_row):
    df = spark.range(3_000).select(
        F.when(F.rand(seed) < 0.6, F.lit("hot"))
        .otherwise((F.rand(seed + 1) * 40).cast("int").cast("string"))
        .alias("Store_id"),
        F.timestamp_micros(
            F.lit(1_704_067_200_000_000) + (F.rand(seed + 2) * 40_000_000_000).cast("long")
        ).alias("eventTime"),
        (F.rand(seed + 3) * 3).cast("int").alias("kind"),
    )
    df = spark.createDataFrame(df.collect(), df.schema)
    gap = "37 seconds"
    if per_row:
        gap = F.when(F.col("kind") == 0, "5 seconds").when(F.col("kind") == 1, "90 seconds")
        gap = gap.otherwise(F.lit("0 seconds"))  # opens no session
    expected = sorted(map(tuple, spark_sessions(df, gap).collect()))
    one_key = df.withColumn("Store_id", F.lit("all"))
    expected_of_all = sorted(r[1:] for r in map(tuple, spark_sessions(one_key, gap).collect()))
    for span in ("1 day", "10 minutes", "7 seconds"):  # shorter than gaps and sessions as well
        got = session_counts(df, "eventTime", "Store_id", gap, keys=["Store_id"], span=span)
        assert sorted(map(tuple, got.collect())) == expected
        of_all = session_counts(df, "eventTime", "Store_id", gap, span=span)
        assert sorted(map(tuple, of_all.collect())) == expected_of_all


def test_batch_sessions_with_missing_keys_and_times(spark):
    rows = [(None, "10:00:00"), (None, "10:00:30"), ("a", "10:00:10"), ("a", None), ("b", "10:59:59"), ("b", "11:00:10")]
    got = session_counts(events(spark, rows), "eventTime", "eventTime", "1 minute", keys=["Store_id"], span="1 hour")
    assert sorted(tuple("-" if v is None else v for v in r) for r in got.select("Store_id", "total_counts").collect()) == [
        ("-", 2), ("a", 1), ("b", 2)
    ]


def test_batch_sessions_shuffle_slots_and_sort_no_key_in_one_task(spark, monkeypatch):
    df = spark.range(10).select(
        F.col("id").cast("string").alias("Store_id"), F.timestamp_seconds("id").alias("eventTime")
    )
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    staged = []
    monkeypatch.setattr(windows, "stage", lambda df, label: staged.append(plan_of(df)) or stage(df, label))
    for keys in ([], ["Store_id"]):
        counts = session_counts(df, "eventTime", "Store_id", "1 minute", keys=keys)
        local, joined = staged.pop(), plan_of(counts)
        assert "partial_count" in local.split("Exchange")[-1]
        assert local.count("Exchange") == 2 and "__range" in local.split("Exchange")[1]
        # by key alone: one row per range
        ordered = joined.split("Exchange hashpartitioning(")
        assert "SinglePartition" not in joined
        assert [part for part in ordered if "__all" in part.split(",")[0 if not keys else 1]]


def test_one_row_per_event_time_and_key(spark):
    """Equal times are one session, however many rows share them."""
    df = events(spark, [("a", "10:00:00")] * 50)
    assert counted(session(df)) == [("a", 50, "10:00:00", "10:01:00")]
    assert datetime(2024, 1, 1, 10) == df.first().eventTime
