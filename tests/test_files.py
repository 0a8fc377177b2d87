from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql.utils import AnalysisException

from tidemark import session
from tidemark.operators.scd2 import Dimension
from tidemark.plans.catalogue import QUERIES
from tidemark.sinks import tables
from tidemark.sinks.external import write_jdbc, write_warehouse
from tidemark.sinks.files import overwrite_directory, write_csv, write_lines, write_parquet
from tidemark.sources import files
from tidemark.sources.external import JdbcDatabase, Ranges, read_jdbc, read_warehouse

SAMPLE = "a long, b double, c string, d date, e timestamp"


def sample(spark):
    return files.rows(
        spark,
        [(i, i + 1.0, f"text {i}", date(2000, i, 1), datetime(2000, 1, i, 12)) for i in (1, 2, 3)],
        SAMPLE,
    )


def test_csv_keeps_values_under_a_schema_and_only_text_without(spark, path):
    folder = path()
    write_csv(sample(spark), folder)
    typed = files.read_csv(spark, folder, header=True, schema=SAMPLE)
    assert sorted(typed.collect()) == sorted(sample(spark).collect())
    untyped = files.read_csv(spark, folder, header=True)
    assert {kind for _, kind in untyped.dtypes} == {"string"}
    inferred = files.read_csv(spark, folder, header=True, infer=True)
    assert dict(inferred.dtypes) == {
        "a": "int", "b": "double", "c": "string", "d": "date", "e": "timestamp"
    }


def test_headerless_csv_keeps_its_first_row(spark, path):
    folder = path()
    write_csv(sample(spark).coalesce(1), folder, header=False)
    assert files.read_csv(spark, folder, header=False, schema=SAMPLE).count() == 3
    files.csv_view(spark, "headerless", SAMPLE, folder)
    assert spark.sql("SELECT sum(a) FROM headerless").first()[0] == 6


def test_header_that_contradicts_the_schema_is_an_error(spark, path):
    folder = path()
    write_csv(sample(spark).select("b", "a"), folder)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, folder, header=True, schema="a long, b double").collect()


def test_separator(spark, path):
    folder = path()
    write_lines(files.rows(spark, [("1|x,y",)], "value string"), folder)
    got = files.read_csv(spark, folder, header=False, schema="n int, t string", separator="|")
    assert got.collect() == [(1, "x,y")]


@pytest.mark.parametrize("write", [write_csv, write_parquet])
def test_existing_path_is_refused(spark, path, write):
    folder = path()
    write(sample(spark), folder)
    with pytest.raises(AnalysisException, match="already exists"):
        write(sample(spark), folder)


def test_overwritten_directory(spark, path):
    folder = path()
    write_csv(sample(spark), folder, header=False)
    overwrite_directory(spark, folder, "SELECT 'only' AS a, 1 AS b")
    got = files.read_csv(spark, folder, header=False, schema="a string, b int")
    assert got.collect() == [("only", 1)]


def test_warehouse_connector_is_a_format_and_options(spark, path):
    folder = path()
    write_warehouse(sample(spark), "orc", path=folder)
    write_warehouse(sample(spark), "orc", path=folder)  # overwrites
    assert read_warehouse(spark, "orc", path=folder).count() == 3


class Recorder:
    """Stands in for a session, a reader or a writer; remembers the calls."""

    def __init__(self):
        self.options_set, self.calls = {}, []
        self.read = self.write = self

    def options(self, **options):
        self.options_set.update(options)
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


SHOP = JdbcDatabase("jdbc:postgresql://db/shop", "org.postgresql.Driver", {"user": "u"})
BASE = {"url": SHOP.url, "driver": SHOP.driver, "dbtable": "orders", "user": "u"}


def test_jdbc_read_in_ranges():
    spark = Recorder()
    read_jdbc(spark, SHOP, "orders", split=Ranges("order_id", 1, 1_000_000, 64))
    assert spark.options_set == BASE | {
        "partitionColumn": "order_id",
        "lowerBound": "1",
        "upperBound": "1000000",
        "numPartitions": "64",
        "fetchsize": 10_000,
    }
    assert [c[0] for c in spark.calls] == ["format", "load"]


def test_jdbc_read_by_predicates():
    spark = Recorder()
    read_jdbc(spark, SHOP, "orders", predicates=["k < 5", "k >= 5 OR k IS NULL"])
    (name, args, kwargs), = spark.calls
    assert (name, args) == ("jdbc", (SHOP.url, "orders"))
    assert kwargs["predicates"] == ["k < 5", "k >= 5 OR k IS NULL"]
    assert kwargs["properties"] == {"driver": SHOP.driver, "fetchsize": "10000", "user": "u"}


def test_jdbc_write():
    df = Recorder()
    write_jdbc(df, SHOP, "orders", mode="overwrite", connections=4)
    assert df.options_set == BASE | {"numPartitions": 4, "batchsize": 10_000}
    assert [c[:2] for c in df.calls] == [
        ("format", ("jdbc",)), ("mode", ("overwrite",)), ("save", ())
    ]


class Cluster:
    """A session whose configuration and master are given."""

    def __init__(self, configured=None, checkpoint=None, master="spark://host:7077"):
        self.conf = type("Conf", (), {"get": lambda _, key, default: configured})()
        self.sparkContext = type(
            "Context", (), {"getCheckpointDir": lambda _: checkpoint, "master": master}
        )()


def test_scratch_folder_is_the_one_the_cluster_names():
    assert session.scratch_root(Cluster(configured="s3a://shared/tmp/")) == "s3a://shared/tmp"
    assert session.scratch_root(Cluster(checkpoint="hdfs:/ck")) == "hdfs:/ck"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster())


def test_local_session_without_a_shared_folder_gets_one():
    local = Cluster(master="local[2]")
    made = []
    type(local.sparkContext).setCheckpointDir = lambda _, folder: made.append(folder)
    type(local.sparkContext).getCheckpointDir = lambda _: made[-1] if made else None
    assert session.scratch_root(local) == made[0] == session.scratch_root(local)


# Scratch folder ----------------------------------------------------------------------------------


@pytest.fixture
def outside(monkeypatch):
    """As if no run were open: the one of the test itself is out of sight."""
    token = session._RUN.set(None)
    yield
    session._RUN.reset(token)


def runs(spark):
    """The folders of runs that have a record of their owner."""
    found = session.if_present(spark.read, f"{session.scratch_root(spark)}/tidemark/run-*/owner")
    return set() if found is None else {r.folder for r in found.collect()}


def test_what_a_run_stages_goes_with_it(spark, outside):
    before = runs(spark)
    with session.scratch_run(spark):
        staged = session.stage(spark.range(5), "five")
        with session.scratch_run(spark):  # belongs to the outer one
            inner = session.stage(spark.range(3), "three")
        assert (staged.count(), inner.count()) == (5, 3)
        (folder,) = runs(spark) - before
        assert all(folder in f for df in (staged, inner) for f in df.inputFiles())
    assert runs(spark) == before
    with pytest.raises(ZeroDivisionError):
        with session.scratch_run(spark):
            session.stage(spark.range(5), "five")
            1 / 0
    assert runs(spark) == before
    assert session.if_present(spark.read, folder) is None


def test_what_dead_runs_left_is_swept(spark, outside):
    dead = session.scratch_run(spark)
    dead.__enter__()
    session.stage(spark.range(5), "five")
    lost = session._RUN.get()
    session._RUN.set(None)  # its driver is gone
    assert lost in runs(spark)
    session.sweep_runs(spark, timedelta(hours=1))
    assert lost in runs(spark)
    assert session.sweep_runs(spark, timedelta(0)) >= 1
    assert lost not in runs(spark)


def test_only_scratch_folders_are_removed(spark):
    with pytest.raises(ValueError, match="is not below"):
        session.remove_folder(spark, "/somewhere/else")


def test_merges_and_replacements_leave_nothing_staged(spark, database, outside):
    before = runs(spark)
    dim = Dimension(key="id", surrogate="sk", tracked=("company",))
    table, other = f"{database}.history", f"{database}.t"
    for company in "AB":
        tables.merge_table(spark.createDataFrame([(1, company)], "id int, company string"), table, dim, buckets=2)
    tables.save_table(spark.range(5).toDF("a"), other)
    tables.replace_rows(spark.table(other).filter("a > 2"), other)
    assert (spark.table(table).count(), spark.table(other).count()) == (2, 2)
    assert runs(spark) == before


def test_queries_leave_settings_and_views_as_they_were(spark):
    names = ("spark.sql.session.timeZone", session.MERGE_SESSIONS_EARLY)
    spark.conf.set(names[0], "America/New_York")
    spark.conf.set(names[1], "false")
    try:
        QUERIES["csv_view"](spark, "/root/testdata/sf0.001")
        QUERIES["sql_daily_revenue"](spark, "/root/testdata/sf0.001")
        assert [spark.conf.get(n) for n in names] == ["America/New_York", "false"]
        assert not [t.name for t in spark.catalog.listTables() if t.isTemporary]
    finally:
        spark.conf.set(names[0], "UTC")
        spark.conf.set(names[1], "true")


# Order of files ----------------------------------------------------------------------------------


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_rows_come_back_in_the_order_written(spark, path, split):
    """Over several files, also where a scan cuts them into blocks and packs these into tasks."""
    folder = path()
    df = spark.range(5000).selectExpr("id * 7919 % 5000 AS k", "repeat('x', 20) AS t")
    write_csv(df.orderBy("k"), folder, header=False)
    with session.settings(spark, {"spark.sql.files.maxPartitionBytes": split}):
        rows = files.in_written_order(files.read_csv(spark, folder, header=False, schema="k long, t string"))
        assert rows.columns == ["k", "t", "place"]
        assert all(r.k == r.place for r in rows.collect())
    assert rows.count() == 5000
