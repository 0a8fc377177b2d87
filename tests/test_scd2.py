from __future__ import annotations

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scd2
from tidemark.operators.scd2 import Dimension, HistoryError

DIM = Dimension(key="id", surrogate="sk", tracked=("company", "email"))
SOURCE = "id int, title string, company string, email string"

OLD = datetime(2020, 1, 1)
ENDED = datetime(2021, 6, 1)
NOW = datetime(2024, 1, 1)
OPEN = datetime(9999, 12, 31, 23, 59, 59)


def at(moment):
    """A moment in the session's zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def source(spark, rows):
    return spark.createDataFrame(rows, SOURCE)


def history(spark, rows):
    """Rows ``(id, title, company, email, sk, is_current)``."""
    df = spark.createDataFrame(rows, f"{SOURCE}, sk bigint, is_current boolean")
    until = F.when(F.col("is_current"), at(OPEN)).otherwise(at(ENDED))
    return df.withColumns({"effective_date": at(OLD), "expiration_date": until}).select(
        *DIM.history_columns(["id", "title", "company", "email"])
    )


def plain(df):
    """Rows as tuples with zoneless times, sorted by surrogate key."""
    times = ("effective_date", "expiration_date")
    shown = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})
    return sorted((tuple(r) for r in shown.collect()), key=lambda r: (r[4], r[5]))


def merge(old, new):
    return scd2.scd2_merge(old, new, DIM, as_of=at(NOW))


def test_each_action(spark):
    old = history(
        spark,
        [
            (1, "Ms", "A", "a@x", 1, True),
            (2, "Mr", "B", "b@x", 2, True),
            (3, "Mr", "C", "c@x", 3, True),
            (9, "Mr", "Z", "z@x", 4, False),
        ],
    )
    new = source(spark, [(1, "Dr", "A", "a@x"), (2, "Dr", "B2", "b@x"), (4, "Ms", "D", "d@x")])
    assert plain(merge(old, new)) == [
        (1, "Ms", "A", "a@x", 1, OLD, OPEN, True),  # only the untracked title differs
        (2, "Mr", "B", "b@x", 2, OLD, NOW, False),
        (3, "Mr", "C", "c@x", 3, OLD, NOW, False),
        (9, "Mr", "Z", "z@x", 4, OLD, ENDED, False),
        (4, "Ms", "D", "d@x", 5, NOW, OPEN, True),  # inserts first
        (2, "Dr", "B2", "b@x", 6, NOW, OPEN, True),  # updates take untracked columns, too
    ]


def test_initial_load_numbers_in_key_order(spark):
    new = source(spark, [(30, "t", "c", "e"), (10, "t", "c", "e"), (20, "t", "c", "e")])
    got = plain(scd2.scd2_initial(new, DIM, as_of=at(NOW)))
    assert [(r[0], r[4]) for r in got] == [(10, 1), (20, 2), (30, 3)]
    assert {r[5:] for r in got} == {(NOW, OPEN, True)}


def test_source_columns_may_have_any_name(spark):
    dim = Dimension(key="key", surrogate="sk", tracked=("action", "h"))
    columns = "key int, action string, h string, c string, rows int"
    new = spark.createDataFrame([(2, "a", "h", "c", 1), (1, "a", None, "c", 1)], columns)
    first = scd2.scd2_initial(new, dim, as_of=at(OLD))
    changed = new.withColumn("h", F.lit("new"))
    got = scd2.scd2_merge(first, changed, dim, as_of=at(NOW)).select("key", "h", "sk", "is_current")
    assert sorted(got.collect(), key=lambda r: r.sk) == [
        (1, None, 1, False), (2, "h", 2, False), (1, "new", 3, True), (2, "new", 4, True)
    ]


def test_merge_into_empty_history_equals_initial_load(spark):
    new = source(spark, [(2, "t", "c", "e"), (1, "t", None, "e")])
    assert plain(merge(history(spark, []), new)) == plain(
        scd2.scd2_initial(new, DIM, as_of=at(NOW))
    )


@pytest.mark.parametrize(
    "before, after",
    [
        (("a", None), (None, "a")),  # joined text skips NULLs
        (("a_b", "c"), ("a", "b_c")),  # and does not escape the separator
        ((None, "a"), ("", "a")),
    ],
)
def test_changes_that_joined_text_misses(spark, before, after):
    old = history(spark, [(1, "t", *before, 1, True)])
    got = plain(merge(old, source(spark, [(1, "t", *after)])))
    assert [(r[4], r[7]) for r in got] == [(1, False), (2, True)]


def test_null_equals_null(spark):
    old = history(spark, [(1, "t", None, "e", 1, True)])
    assert plain(merge(old, source(spark, [(1, "t", None, "e")]))) == plain(old)


def test_highest_key_on_a_closed_row_is_not_used_again(spark):
    old = history(spark, [(1, "t", "A", "e", 1, True), (2, "t", "B", "e", 7, False)])
    got = plain(merge(old, source(spark, [(1, "t", "A2", "e")])))
    assert [r[4] for r in got] == [1, 7, 8]


def test_key_that_comes_back_is_inserted(spark):
    old = history(spark, [(1, "t", "A", "e", 1, False)])
    got = plain(merge(old, source(spark, [(1, "t", "A", "e")])))
    assert [(r[4], r[7]) for r in got] == [(1, False), (2, True)]


def test_row_without_key_is_quarantined(spark):
    new = source(spark, [(None, "t", "A", "e"), (1, "t", "A", "e")])
    valid, missing = scd2.split_missing_keys(new, DIM)
    assert (valid.count(), missing.count()) == (1, 1)
    with pytest.raises(scd2.HistoryError, match="1 source rows have no id"):
        merge(history(spark, []), new)
    taken = []
    merged = scd2.scd2_merge(
        history(spark, []), new, DIM, as_of=at(NOW), quarantine=lambda rows, n: taken.append((n, rows.count()))
    )
    assert [r[0] for r in plain(merged)] == [1]
    assert taken == [(1, 1)]


def test_repeated_keys_are_refused(spark):
    twice = source(spark, [(5, "t", "A", "e"), (5, "t", "B", "e"), (6, "t", "A", "e")])
    with pytest.raises(HistoryError, match="source 5 x2"):
        merge(history(spark, []), twice)
    with pytest.raises(HistoryError, match="source 5 x2"):
        scd2.scd2_initial(twice, DIM)
    two_open = history(spark, [(5, "t", "A", "e", 1, True), (5, "t", "A", "e", 2, True)])
    for given in ([(5, "t", "A", "e")], [(6, "t", "A", "e")]):
        with pytest.raises(HistoryError, match="history 5 x2"):
            merge(two_open, source(spark, given))


def test_unset_current_flag_is_refused(spark):
    old = history(spark, [(1, "t", "A", "e", 1, None)])
    with pytest.raises(HistoryError, match="is_current"):
        merge(old, source(spark, [(1, "t", "A", "e")]))


def test_no_tracked_columns_means_no_updates(spark):
    old = history(spark, [(1, "t", "A", "e", 1, True)])
    dim = Dimension(key="id", surrogate="sk", tracked=())
    got = scd2.scd2_merge(old, source(spark, [(1, "x", "B", "f")]), dim, as_of=at(NOW))
    assert plain(got) == plain(old)


def test_now_is_fixed_when_the_call_is_made(spark):
    got = scd2.scd2_merge(history(spark, []), source(spark, [(1, "t", "A", "e")]), DIM)
    first = got.first().effective_date
    assert first == got.first().effective_date
    age = datetime.now(timezone.utc).timestamp() - got.select(
        F.col("effective_date").cast("double")
    ).first()[0]
    assert 0 <= age < 120


def test_history_by_day(spark):
    dim = Dimension(key="id", surrogate="sk", tracked=("company",), time_type="date")
    old = scd2.scd2_initial(source(spark, [(1, "t", "A", "e")]), dim, as_of=at(OLD))
    new = source(spark, [(1, "t", "B", "e")])
    got = scd2.scd2_merge(old, new, dim, as_of=at(NOW))
    shown = got.select("sk", "effective_date", "expiration_date").collect()
    end = OPEN.date()
    assert sorted(shown) == [(1, OLD.date(), NOW.date()), (2, NOW.date(), end)]


def brute_force(old, new):
    """The rules, row by row."""
    opened = {r[0]: r for r in old if r[7]}
    given = {r[0]: r for r in new}
    result = [r for r in old if not r[7]]
    inserts, updates = [], []
    for key in sorted(opened.keys() | given.keys()):
        row, now = opened.get(key), given.get(key)
        if now is None:
            result.append((*row[:6], NOW, False))
        elif row is None:
            inserts.append(now)
        elif row[2:4] == now[2:4]:
            result.append(row)
        else:
            result.append((*row[:6], NOW, False))
            updates.append(now)
    top = max((r[4] for r in old), default=0)
    for number, now in enumerate(inserts + updates, top + 1):
        result.append((*now, number, NOW, OPEN, True))
    return sorted(result, key=lambda r: (r[4], r[5]))


@pytest.mark.parametrize("seed", range(4))
def test_random_histories(spark, seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice(["a", "b", "a_b", "", None])
    keys = rng.sample(range(400), 200)
    old = history(
        spark,
        [(k, pick(), pick(), pick(), sk, rng.random() < 0.8) for sk, k in enumerate(keys, 1)],
    )
    new_rows = [(k, pick(), pick(), pick()) for k in rng.sample(range(400), 200)]
    new = source(spark, new_rows)

    once = merge(old, new)
    assert plain(once) == brute_force(plain(old), new_rows)

    rows = plain(once)
    live = [r[0] for r in rows if r[7]]
    assert sorted(live) == sorted(k for k, *_ in new_rows)
    assert len({r[4] for r in rows}) == len(rows)
    assert all(r[5] <= r[6] for r in rows)
    assert [r for r in plain(old) if not r[7]] == [r for r in rows if not r[7] and r[6] == ENDED]
    assert plain(merge(once, new)) == rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, path):
    """History and source as files, so that plans show what is read."""
    folders = path("history"), path("source")
    history(spark, [(1, "t", "A", "e", 1, True)]).write.parquet(folders[0])
    source(spark, [(2, "t", "A", "e")]).write.parquet(folders[1])
    return tuple(spark.read.parquet(folder) for folder in folders)


def test_narrow_rows_are_shuffled_and_sorted_once_a_side(stored):
    plan = plan_of(scd2.classify(*stored, DIM))
    assert "ReadSchema: struct<id:int,company:string,email:string>" in plan
    assert plan.count("Exchange hashpartitioning") == plan.count("Sort [") == 2
    assert "Aggregate" not in plan


def test_copies_of_a_key_do_not_multiply_in_the_join(spark):
    """One key in most rows of both sides: one row for it comes out, and it is refused."""
    old = history(spark, [(1, "t", "A", "e", 1, True)] * 3000 + [(2, "t", "B", "e", 2, True)])
    new = source(spark, [(1, "t", "A", "e")] * 3000 + [(None, "t", "A", "e")] * 50)
    found = {r.key: r[1:] for r in scd2.classify(old, new, DIM).collect()}
    assert found == {1: (scd2.NOCHANGE, True, True), 2: (scd2.DELETE, False, False)}
    with pytest.raises(HistoryError, match="history 1 x3000"):
        scd2.find_changes(old, new.dropna(subset="id"), DIM)
    with pytest.raises(HistoryError, match="source 1 x3000"):
        scd2.find_changes(old.limit(0), new.dropna(subset="id"), DIM)


def test_whole_rows_are_not_shuffled_where_few_keys_change(spark, stored):
    plan = plan_of(merge(*stored))
    assert "SortMergeJoin" not in plan
    # the rest counts the rows per range of the numbering
    assert plan.count("Exchange hashpartitioning") == plan.count("hashpartitioning(__part") == 1


def test_whole_rows_are_shuffled_once_where_many_keys_change(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(merge(*stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # open rows and their changed keys, source rows and their numbers; offsets are counted apart
    assert plan.count("Exchange hashpartitioning(id") == 4
