import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import slicing
from ledgerloom.sources import audit

D = dt.date
BOUNDS = "first_day date, last_day date"


def plan(spark, mark, *args):
    bounds = spark.createDataFrame([(D(2020, 1, 1), D(2020, 1, 20))], BOUNDS)
    marks = spark.createDataFrame([(mark,)], "last_loaded_date date")
    return sorted(r[0] for r in slicing.plan_window(bounds, marks, *args).collect())


def test_window_starts_after_the_mark(spark):
    assert plan(spark, D(2020, 1, 3), 2) == [D(2020, 1, 4), D(2020, 1, 5)]


def test_first_window_starts_with_the_source(spark):
    days = plan(spark, None, 7)
    assert (days[0], days[-1], len(days)) == (D(2020, 1, 1), D(2020, 1, 7), 7)


def test_window_ends_with_the_source(spark):
    assert plan(spark, D(2020, 1, 18), 7) == [D(2020, 1, 19), D(2020, 1, 20)]


def test_nothing_to_do_when_caught_up(spark):
    assert plan(spark, D(2020, 1, 20), 7) == []


def test_explicit_range_is_clamped_but_not_capped(spark):
    days = plan(spark, D(2020, 1, 18), 7, D(1990, 1, 1), D(2020, 1, 15))
    assert (days[0], days[-1], len(days)) == (D(2020, 1, 1), D(2020, 1, 15), 15)


AUDIT_ROWS = [
    ("a", "incremental", D(2020, 1, 7), "PASS"),
    ("b", "incremental", D(2020, 1, 14), "FAIL"),
    ("c", "backfill", D(2020, 1, 20), "PASS"),
    ("d", "incremental", D(2020, 1, 10), "PASS"),
    ("e", "incremental", D(2020, 1, 5), "PASS"),
    ("f", "incremental", None, "NOOP"),
]


def history(spark):
    rows = [
        (name, dt.datetime(2020, 2, i + 1), dt.datetime(2020, 2, i + 1, 1), mode, end, end, 1, 1,
         0, status)
        for i, (name, mode, end, status) in enumerate(AUDIT_ROWS)
    ]
    return spark.createDataFrame(rows, audit.AUDIT_SCHEMA)


def test_watermark_counts_passed_incremental_runs_and_never_moves_back(spark):
    mark = audit.watermark(history(spark)).first()
    assert (mark["last_loaded_date"], mark["runs"]) == (D(2020, 1, 10), 3)


def test_watermark_without_history(spark):
    mark = audit.watermark(history(spark).filter("false")).first()
    assert (mark["last_loaded_date"], mark["runs"]) == (None, 0)


def test_recent_runs(spark):
    assert [r["run_id"] for r in audit.recent_runs(history(spark)).collect()] == list("fedcb")


def orders(spark, n=40):
    start = dt.datetime(2020, 1, 1, 9)
    made = [(str(i), (start + dt.timedelta(hours=11 * i)).isoformat(" ")) for i in range(n)]
    return [*made, ("bad", "soon"), ("none", None)]


@pytest.mark.parametrize("lookback", [0, 3])
def test_slices_match_a_scan_per_day(spark, lookback):
    made = orders(spark)
    start, end = D(2020, 1, 4), D(2020, 1, 9)
    want = set()
    for offset in range((end - start).days + 1):
        day = start + dt.timedelta(days=offset)
        for key, text in made[:-2]:
            event = dt.datetime.fromisoformat(text).date()
            if day - dt.timedelta(days=lookback) <= event <= day:
                want.add((key, day))
    df = spark.createDataFrame(made, "order_id string, order_purchase_timestamp string")
    sliced = slicing.slice_orders(df, start, end, lookback).select("order_id", "ingest_date")
    got = [tuple(r) for r in sliced.collect()]
    assert set(got) == want and len(got) == len(want)


def test_items_follow_their_orders_once_per_day(spark):
    days = [("1", D(2020, 1, 1)), ("1", D(2020, 1, 2)), ("1", D(2020, 1, 2)), ("2", D(2020, 1, 2))]
    lines = [("1", i, "x") for i in range(200)] + [("2", 0, "y"), ("3", 0, "z")]
    items = spark.createDataFrame(lines, "order_id string, order_item_id int, note string")
    slices = spark.createDataFrame(days, "order_id string, ingest_date date")
    got = slicing.slice_items(items, slices)
    counts = {tuple(r)[:2]: r[2] for r in got.groupBy("order_id", "ingest_date").count().collect()}
    assert counts == {("1", D(2020, 1, 1)): 200, ("1", D(2020, 1, 2)): 200, ("2", D(2020, 1, 2)): 1}


def test_snapshot_lands_whole_on_each_day(spark):
    df = slicing.daily_snapshot(spark.range(3), D(2020, 1, 1), D(2020, 1, 4))
    assert df.count() == 12 and df.filter(F.col("ingest_date") == D(2020, 1, 4)).count() == 3
