from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators.revenue import daily_revenue
from tidemark.operators.scd2 import Dimension, HistoryError
from tidemark.plans.tables import BILLED, retail_items, retail_orders
from tidemark.sinks import tables
from tidemark.sources import catalog

DIM = Dimension(key="id", surrogate="sk", tracked=("company",))


def day(number):
    return datetime(2024, 1, number, tzinfo=timezone.utc)


def source(spark, rows):
    return spark.createDataFrame(rows, "id int, company string")


def state(spark, table):
    rows = spark.table(table).select("id", "company", "sk", "is_current").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[2], r[3]))


def test_history_table_over_several_merges(spark, database):
    table, synced = f"{database}.history", f"{database}.synced"
    assert not catalog.table_exists(spark, table)

    def merge(rows, number):
        tables.merge_table(source(spark, rows), table, DIM, as_of=day(number), synced=synced)

    merge([(1, "A"), (2, "B")], 1)
    assert state(spark, table) == [(1, "A", 1, True), (2, "B", 2, True)]

    merge([(1, "A2"), (3, "C")], 2)
    second = [(1, "A", 1, False), (2, "B", 2, False), (3, "C", 3, True), (1, "A2", 4, True)]
    assert state(spark, table) == second

    # An unchanged source changes nothing; neither does a second merge at the same time.
    merge([(1, "A2"), (3, "C")], 3)
    assert state(spark, table) == second
    merge([(3, "C")], 2)
    third = [(1, "A", 1, False), (2, "B", 2, False), (3, "C", 3, True), (1, "A2", 4, False)]
    assert state(spark, table) == third

    # No key left: the open partition is emptied.
    merge([], 4)
    assert state(spark, table) == [(*r[:3], False) for r in third]
    assert state(spark, synced) == state(spark, table)
    assert not spark.table(table).filter("effective_date > expiration_date").count()


def test_interrupted_merge_is_completed_by_the_next(spark, database, monkeypatch):
    table, synced = f"{database}.history", f"{database}.synced"
    rows = [(1, "A"), (2, "B")]
    tables.merge_table(source(spark, rows), table, DIM, as_of=day(1), synced=synced)
    finish, calls = tables.finish_merge, []

    def die(session, name):
        calls.append(name)
        if len(calls) == 2:  # the first call finds nothing pending
            raise RuntimeError("driver lost")
        finish(session, name)

    monkeypatch.setattr(tables, "finish_merge", die)
    with pytest.raises(RuntimeError):
        tables.merge_table(source(spark, [(1, "A2")]), table, DIM, as_of=day(2), synced=synced)
    monkeypatch.undo()
    assert state(spark, table) == [(1, "A", 1, True), (2, "B", 2, True)]

    tables.merge_table(source(spark, [(1, "A2")]), table, DIM, as_of=day(3), synced=synced)
    expected = [(1, "A", 1, False), (2, "B", 2, False), (1, "A2", 3, True)]
    assert state(spark, table) == state(spark, synced) == expected
    ended = spark.table(table).filter("NOT is_current").select("expiration_date").distinct()
    assert [r[0].replace(tzinfo=None) for r in ended.collect()] == [datetime(2024, 1, 2)]


def test_merge_goes_by_column_names(spark, database):
    dim = Dimension(key="id", surrogate="sk", tracked=("a", "b"))
    table = f"{database}.by_name"
    first = spark.createDataFrame([(1, "x", "y")], "id int, a string, b string")
    tables.merge_table(first, table, dim, as_of=day(1))
    turned = spark.createDataFrame([(1, "y", "x"), (2, "q", "p")], "id int, b string, a string")
    tables.merge_table(turned, table, dim, as_of=day(2))
    found = spark.table(table).where("is_current").select("id", "a", "b").collect()
    assert sorted(map(tuple, found)) == [(1, "x", "y"), (2, "p", "q")]


def test_merge_leaves_earlier_closed_partitions_alone(spark, database):
    table = f"{database}.history"
    tables.merge_table(source(spark, [(1, "A")]), table, DIM, as_of=day(1))
    tables.merge_table(source(spark, [(1, "B")]), table, DIM, as_of=day(2))

    def closed_files():
        return {r[0] for r in spark.table(table).filter("NOT is_current")
                .select(F.input_file_name()).collect()}

    before = closed_files()
    tables.merge_table(source(spark, [(1, "C")]), table, DIM, as_of=day(3))
    assert before < closed_files()


def open_files(spark, table):
    """The files of each bucket of open rows."""
    rows = spark.table(table).where("is_current").select(tables.KEY_BUCKET, F.input_file_name().alias("file"))
    found = {}
    for row in rows.distinct().collect():
        found.setdefault(row[0], set()).add(row["file"])
    return found


def test_merge_writes_touched_buckets_only(spark, database):
    table, synced = f"{database}.history", f"{database}.synced"
    rows = [(i, f"c{i}") for i in range(400)]
    tables.merge_table(source(spark, rows), table, DIM, as_of=day(1), synced=synced, buckets=16)
    first = {name: open_files(spark, name) for name in (table, synced)}
    assert first[table].keys() == set(range(16))
    bucket = {r.id: r[1] for r in spark.table(table).select("id", tables.KEY_BUCKET).collect()}

    # one key changed, one gone, one new: at most three buckets
    second = [(i, "new" if i == 7 else c) for i, c in rows if i != 11] + [(1000, "x")]
    tables.merge_table(source(spark, second), table, DIM, as_of=day(2), synced=synced)
    new_key = spark.table(table).where("id = 1000").first()[tables.KEY_BUCKET]
    for name in (table, synced):
        now = open_files(spark, name)
        changed = {b for b in now if now[b] != first[name][b]}
        assert changed == {bucket[7], bucket[11], new_key}
    assert state(spark, table) == state(spark, synced)
    open_rows = {(r.id, r.company) for r in spark.table(table).where("is_current").collect()}
    assert open_rows == set(second)

    # the last rows of a bucket go: its partition goes as well
    gone = bucket[7]
    third = [(i, c) for i, c in second if bucket.get(i, new_key) != gone]
    tables.merge_table(source(spark, third), table, DIM, as_of=day(3), synced=synced)
    for name in (table, synced):
        assert open_files(spark, name).keys() == set(range(16)) - {gone}
        held = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        assert f"is_current=true/closed_in=open/key_bucket={gone}" not in held
    assert state(spark, table) == state(spark, synced)


def test_merge_reads_whole_rows_of_touched_buckets_only(spark, database, monkeypatch):
    table = f"{database}.history"
    rows = [(i, f"c{i}") for i in range(100)]
    tables.merge_table(source(spark, rows), table, DIM, as_of=day(1), buckets=8)
    seen = []

    def spy(open_rows, *args, **kwargs):
        seen.append((open_rows._jdf.queryExecution().executedPlan().toString(), open_rows.count()))
        return real(open_rows, *args, **kwargs)

    real = tables.next_versions
    monkeypatch.setattr(tables, "next_versions", spy)
    tables.merge_table(source(spark, [(0, "new"), *rows[1:]]), table, DIM, as_of=day(2))
    ((plan, read),) = seen
    assert "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < read < 100


def test_keys_of_another_type_have_the_same_bucket(spark, database):
    table = f"{database}.history"
    tables.merge_table(source(spark, [(1, "A"), (2, "B"), (3, "C")]), table, DIM, as_of=day(1), buckets=50)
    wide = spark.createDataFrame([(1, "A"), (2, "B2"), (4, "D")], "id long, company string")
    tables.merge_table(wide, table, DIM, as_of=day(2))
    assert state(spark, table) == [
        (1, "A", 1, True), (2, "B", 2, False), (3, "C", 3, False), (4, "D", 4, True), (2, "B2", 5, True)
    ]
    placed = spark.table(table).where("is_current").select(tables.KEY_BUCKET, tables.bucket_of(F.col("id").cast("int"), 50).alias("b"))
    assert all(r[0] == r.b for r in placed.collect())


def test_merge_that_died_between_its_partitions_is_completed(spark, database, monkeypatch):
    """Death after the closed rows, and after the open rows but before emptied buckets are dropped."""
    for at in (1, 2):
        table = f"{database}.history_{at}"
        rows = [(i, "A") for i in range(20)]
        tables.merge_table(source(spark, rows), table, DIM, as_of=day(1), buckets=64)
        sql, calls = type(spark).sql, []

        def dying(session, text, *args, **kwargs):
            if text.startswith(("INSERT OVERWRITE", "ALTER TABLE")) and "TBLPROPERTIES" not in text:
                calls.append(text)
                if len(calls) == at + 1:
                    raise RuntimeError("driver lost")
            return sql(session, text, *args, **kwargs)

        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", dying)
            with pytest.raises(RuntimeError):
                tables.merge_table(source(spark, [(5, "A"), (6, "B")]), table, DIM, as_of=day(2))
        tables.merge_table(source(spark, [(5, "A"), (6, "B")]), table, DIM, as_of=day(3))
        expected = [(i, "A", i + 1, i == 5) for i in range(20)] + [(6, "B", 21, True)]
        assert state(spark, table) == expected


def open_history(spark, table, ends="9999-12-31 23:59:59"):
    rows = spark.createDataFrame([(1, "A", 1), (2, "B", 2)], "id int, company string, sk int")
    times = {"effective_date": F.lit(day(1)), "expiration_date": F.lit(ends).cast("timestamp"), "is_current": F.lit(True)}
    tables.save_history(rows.withColumns(times), table, DIM)


def test_open_rows_with_any_end_are_replaced(spark, database):
    table = f"{database}.history"
    open_history(spark, table, "9999-12-31 00:00:00")
    tables.merge_table(source(spark, [(1, "A"), (2, "B2")]), table, DIM, as_of=day(2))
    expected = [(1, "A", 1, True), (2, "B", 2, False), (2, "B2", 3, True)]
    assert state(spark, table) == expected
    tables.merge_table(source(spark, [(1, "A"), (2, "B2")]), table, DIM, as_of=day(3))
    assert state(spark, table) == expected


def test_copy_that_missed_a_merge_becomes_whole(spark, database):
    table, synced = f"{database}.history", f"{database}.synced"
    for number, company, copied in ((1, "A", True), (2, "B", False), (3, "C", True), (4, "D", True)):
        copy = {"synced": synced} if copied else {}
        tables.merge_table(source(spark, [(1, company)]), table, DIM, as_of=day(number), **copy)
    assert len(state(spark, table)) == 4
    assert sorted(spark.table(synced).collect()) == sorted(spark.table(table).collect())


def test_times_do_not_depend_on_the_zone_of_the_session(spark, database):
    table = f"{database}.history"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        tables.merge_table(source(spark, [(1, "A")]), table, DIM, as_of=day(1))
        tables.merge_table(source(spark, [(1, "B")]), table, DIM, as_of=day(2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    closed = spark.table(table).filter("NOT is_current").select(F.unix_seconds("expiration_date")).first()[0]
    started = spark.table(table).filter("is_current").select(F.unix_seconds("effective_date")).first()[0]
    assert closed == started == day(2).timestamp()


def test_lost_staged_result(spark, database, monkeypatch):
    table = f"{database}.history"
    tables.merge_table(source(spark, [(1, "A")]), table, DIM, as_of=day(1))

    def die_in(function):
        with monkeypatch.context() as patch:
            patch.setattr(tables, *function)
            with pytest.raises(RuntimeError, match="driver lost"):
                tables.merge_table(source(spark, [(1, "B")]), table, DIM, as_of=day(2))
        staged = tables._get(spark, table, tables._PENDING)["staged"]
        spark.sql(f"DROP TABLE {staged}")

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    die_in(("_apply", lost))  # nothing is written yet: the next merge starts afresh
    tables.merge_table(source(spark, [(1, "C")]), table, DIM, as_of=day(2))
    assert state(spark, table) == [(1, "A", 1, False), (1, "C", 2, True)]
    begun = tables._apply

    def half(session, pending, target, *, marked):
        begun(session, pending | {"closes": "0"}, target, marked=marked)
        lost()

    die_in(("_apply", half))
    with pytest.raises(HistoryError, match="has begun to write"):
        tables.merge_table(source(spark, [(1, "C")]), table, DIM, as_of=day(3))


def test_merge_into_the_past_is_refused(spark, database):
    table = f"{database}.history"
    tables.merge_table(source(spark, [(1, "A")]), table, DIM, as_of=day(3))
    for _ in range(2):  # the second time by what the merge left behind
        with pytest.raises(HistoryError, match="before the last change"):
            tables.merge_table(source(spark, [(1, "B")]), table, DIM, as_of=day(2))
        tables.merge_table(source(spark, []), table, DIM, as_of=day(4))


def test_merge_without_changes_writes_nothing(spark, database):
    table = f"{database}.history"
    tables.merge_table(source(spark, [(1, "A")]), table, DIM, as_of=day(1))
    before = set(spark.table(table).inputFiles())
    tables.merge_table(source(spark, [(1, "A")]), table, DIM, as_of=day(2))
    assert set(spark.table(table).inputFiles()) == before
    tables.merge_table(source(spark, [(1, "A"), (2, "B")]), table, DIM, as_of=day(3))
    held = {r.partition.rsplit("/", 1)[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert held == {"is_current=true/closed_in=open"}
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if not r.isTemporary] == ["history"]


def test_rows_without_a_key_are_refused_or_handed_over(spark, database):
    table, given = f"{database}.history", []

    def keep(rows, count):
        given.append((count, sorted(r.company for r in rows.collect())))

    first = source(spark, [(1, "A"), (None, "x"), (None, "y")])
    with pytest.raises(HistoryError, match="2 source rows have no id"):
        tables.merge_table(first, table, DIM, as_of=day(1))
    assert not catalog.table_exists(spark, table)
    tables.merge_table(first, table, DIM, as_of=day(1), quarantine=keep)
    second = source(spark, [(1, "B"), (None, "z")])
    with pytest.raises(HistoryError, match="1 source rows have no id"):
        tables.merge_table(second, table, DIM, as_of=day(2))
    tables.merge_table(second, table, DIM, as_of=day(2), quarantine=keep)
    assert given == [(2, ["x", "y"]), (1, ["z"])]
    assert state(spark, table) == [(1, "A", 1, False), (1, "B", 2, True)]


def test_history_of_another_layout_is_refused(spark, database):
    table = f"{database}.history"
    tables.save_table(source(spark, [(1, "A")]), table)
    with pytest.raises(HistoryError, match="save_history"):
        tables.merge_table(source(spark, [(1, "B")]), table, DIM, as_of=day(2))


def test_history_table_by_day(spark, database):
    table = f"{database}.history"
    dim = Dimension(key="id", surrogate="sk", tracked=("company",), time_type="date")
    for number, company in ((1, "A"), (2, "B"), (2, "C")):
        tables.merge_table(source(spark, [(1, company)]), table, dim, as_of=day(number))
    assert state(spark, table) == [(1, "A", 1, False), (1, "B", 2, False), (1, "C", 3, True)]
    assert dict(spark.table(table).dtypes)["expiration_date"] == "date"


def test_insert_and_overwrite(spark, database):
    catalog.use_database(spark, database)
    try:
        catalog.create_table(spark, "t", "a INT, b STRING")
        tables.insert_into(spark, "t", "SELECT 1, 'x'")
        tables.insert_into(spark, "t", "SELECT 2, 'y'")
        assert sorted(catalog.read_table(spark, "t").collect()) == [(1, "x"), (2, "y")]
        tables.insert_overwrite(spark, "t", "SELECT 3, 'z'")
        assert spark.table("t").collect() == [(3, "z")]
    finally:
        catalog.use_database(spark, "default")


def test_table_replaced_by_a_result_of_itself(spark, database):
    table = f"{database}.t"
    tables.save_table(spark.range(5).toDF("a"), table)
    tables.replace_rows(spark.table(table).filter("a > 2"), table)
    assert sorted(r.a for r in spark.table(table).collect()) == [3, 4]


def test_copied_table(spark, database):
    source, target = f"{database}.source", f"{database}.target"
    tables.save_table(spark.range(3), source)
    tables.copy_table(spark, source, target)
    tables.insert_into(spark, source, "SELECT 3L")
    tables.copy_table(spark, source, target)
    assert sorted(r.id for r in spark.table(target).collect()) == [0, 1, 2, 3]


def test_save_refuses_an_existing_table(spark, database):
    table = f"{database}.t"
    tables.save_table(spark.range(1), table)
    with pytest.raises(Exception, match="already exists"):
        tables.save_table(spark.range(1), table)


def test_revenue_over_bucketed_tables_shuffles_days_only(spark, database):
    orders, items = f"{database}.orders", f"{database}.order_items"
    sf_dir = "/root/testdata/sf0.001"
    tables.save_table(retail_orders(spark, sf_dir), orders, buckets=(8, "order_id"))
    tables.save_table(retail_items(spark, sf_dir), items, buckets=(8, "order_item_order_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = daily_revenue(spark.table(orders), spark.table(items), statuses=BILLED)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert plan.count("Exchange") == plan.count("Exchange hashpartitioning(order_date") == 1
        plain = daily_revenue(
            retail_orders(spark, sf_dir), retail_items(spark, sf_dir), statuses=BILLED
        )
        assert sorted(report.collect()) == sorted(plain.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_drop_database(spark):
    catalog.create_database(spark, "gone_soon")
    catalog.drop_database(spark, "gone_soon")
    catalog.drop_database(spark, "gone_soon")
    assert not spark.catalog.databaseExists("gone_soon")
