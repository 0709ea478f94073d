import datetime as dt

import retail_files as rf
from conftest import TESTDATA

from ledgerloom.params import Params
from ledgerloom.plans import daily_run as dr
from ledgerloom.plans import staging
from ledgerloom.sources import lake
from ledgerloom.sources.files import read_sources
from ledgerloom.streaming import feed, ingest


def land_all(spark, tmp_path):
    made = rf.tables()
    source = rf.write(tmp_path / "source", made)
    job = dr.Job(spark, source, str(tmp_path / "warehouse"), Params(), clock=rf.Clock())
    dr.land_window(job, read_sources(spark, source), dr.Window(rf.day(0), rf.day(rf.DAYS - 1)))
    return job, made


def test_stream_ends_in_the_batch_fact(spark, tmp_path):
    job, made = land_all(spark, tmp_path)
    for _ in range(2):
        query = feed.stream_fact(job, str(tmp_path / "checkpoint"), files_per_batch=100)
        query.awaitTermination()
    fact = spark.read.schema(dr.FACT_SCHEMA).parquet(job.mart("fct_daily_sales")).collect()
    got = {(r["order_date"], r["product_id"]): (r["units"], r["revenue"]) for r in fact}
    assert got == rf.expected_fact(made) and len(got) == len(fact)
    # A replayed batch changes nothing.
    feed.refresh_fact(job, feed.landed_keys(
        *(lake.read_raw(spark, job.root, t) for t in ("orders", "order_items"))))
    assert spark.read.parquet(job.mart("fct_daily_sales")).count() == len(fact)


def test_lines_that_land_after_their_orders(spark, tmp_path):
    made = rf.tables()
    late = {**made, "order_items": [i for i in made["order_items"] if not i["order_id"].startswith("o2_")]}
    source = rf.write(tmp_path / "source", late)
    job = dr.Job(spark, source, str(tmp_path / "warehouse"), Params(), clock=rf.Clock())
    window = dr.Window(rf.day(0), rf.day(4))

    def stream():
        dr.land_window(job, read_sources(spark, source), window)
        feed.stream_fact(job, str(tmp_path / "checkpoint")).awaitTermination()
        fact = spark.read.schema(dr.FACT_SCHEMA).parquet(job.mart("fct_daily_sales")).collect()
        return {(r["order_date"], r["product_id"]): (r["units"], r["revenue"]) for r in fact}

    assert stream() == rf.expected_fact(late, 5)
    rf.write(tmp_path / "source", made)
    assert stream() == rf.expected_fact(made, 5)


def test_only_touched_days_are_rebuilt(spark, tmp_path):
    job, made = land_all(spark, tmp_path)
    batch = feed.landed_keys(*(lake.read_raw(spark, job.root, t) for t in ("orders", "order_items")))
    one = batch.filter("order_id = 'o6_1' AND day IS NULL")
    assert feed.touched_days(job, one) == [rf.day(6)]
    feed.refresh_fact(job, one)
    fact = spark.read.schema(dr.FACT_SCHEMA).parquet(job.mart("fct_daily_sales")).collect()
    want = {k: v for k, v in rf.expected_fact(made).items() if k[0] == rf.day(6)}
    assert {(r["order_date"], r["product_id"]): (r["units"], r["revenue"]) for r in fact} == want


def test_stream_keeps_the_last_row_per_key(spark, rows, tmp_path):
    job, _ = land_all(spark, tmp_path)
    path = str(tmp_path / "latest")
    keys, ties = ("order_id",), staging.ORDER_TIES
    stream = feed.raw_stream(spark, job.root, "orders", files_per_batch=4)
    feed.stream_latest(stream, path, keys, ties, str(tmp_path / "checkpoint")).awaitTermination()
    raw = lake.read_raw(spark, job.root, "orders")
    columns = [*keys, *ties, "_ingest_date", "_loaded_at"]
    want = staging.latest_wins(raw.select(*columns), keys, ties)
    assert rows(feed.latest_table(spark, path, keys, ties).read()) == rows(want)


def test_daily_totals_close_after_the_lateness(spark, rows, tmp_path):
    events = spark.read.parquet(f"{TESTDATA}/sf0.001/events.parquet")
    split = dt.datetime(2024, 1, 15)
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.filter(events.ts < split).coalesce(1).write.mode("append").parquet(inbox)

    def drain():
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        feed.stream_daily_totals(stream, out, str(tmp_path / "cp")).awaitTermination()
        return spark.read.parquet(out)

    drain()
    late = spark.createDataFrame([(10**9, dt.datetime(2024, 1, 13, 5), 1, "late", 2.0, "{}")], events.schema)
    events.filter(events.ts >= split).unionByName(late).coalesce(1).write.mode("append").parquet(inbox)
    got = drain()
    batch = feed.daily_totals(events.unionByName(late))
    closed = got.agg({"event_day": "max"}).first()[0]
    assert closed >= dt.date(2024, 1, 25)
    assert rows(got) == rows(batch.filter(batch.event_day <= closed))


def test_late_rows_are_kept(spark, rows, tmp_path):
    """Totals plus late rows are the input, whatever the batches, and a replay changes nothing."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    inbox, path = str(tmp_path / "in"), str(tmp_path / "days")

    def event(n, day, hour=0, value=1.25):
        ts = None if day is None else dt.datetime(2024, 1, day, hour)
        return (n, ts, 1, "buy", value, "{}")

    batches = [[event(1, 1), event(2, 2, 5)], [event(3, 9, 3), event(4, 1, 23)],
               [event(5, 1, 7), event(6, 5, 23), event(7, 6, 3), event(8, None)],
               [event(9, 20), event(10, 9, 23, None)]]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(inbox)
        feed.stream_closed_days(stream, path, str(tmp_path / "cp")).awaitTermination()
    days = feed.ClosedDays(spark, path, spark.createDataFrame([], schema).schema, "3 days")
    # After the second batch days up to the 5th are closed: they end 3 days before the 9th, 3:00.
    assert sorted(r["event_id"] for r in days.late().collect()) == [5, 6, 8]
    every = spark.createDataFrame([e for b in batches for e in b], schema)
    on_time = every.join(days.late().select("event_id"), "event_id", "left_anti")
    assert rows(days.totals().unionByName(days.totals(closed=False))) == rows(feed.daily_totals(on_time))
    assert days.totals().agg({"event_day": "max"}).first()[0] == dt.date(2024, 1, 9)
    before = rows(days.totals())
    days.add(every, 1)
    assert rows(days.totals()) == before and days.late().count() + on_time.count() == every.count()


def split_orders(tmp_path, made):
    """The source files, the orders in one file per two days."""
    source = rf.write(tmp_path / "source", {**made, "orders": made["orders"][:8]})
    for n in range(1, 5):
        name = tmp_path / "source" / f"{n}_orders_dataset.csv"
        part = rf.write(tmp_path / f"part{n}", {"orders": made["orders"][8 * n:8 * n + 8]})
        name.write_text((tmp_path / f"part{n}" / rf.FILES["orders"]).read_text())
        assert part
    return source


def lake_rows(spark, rows, job, table):
    raw = lake.read_raw(spark, job.root, table)
    return rows(raw.drop("_loaded_at"))


def test_files_land_as_they_arrive(spark, rows, tmp_path):
    made = rf.tables()
    source = split_orders(tmp_path, made)
    clock = rf.Clock()
    batch = dr.Job(spark, source, str(tmp_path / "batch"), Params(), clock=clock)
    dr.land_window(batch, read_sources(spark, source), dr.Window(rf.day(0), rf.day(rf.DAYS - 1)))
    # A file that breaks the contract lands nothing, and the others land all the same.
    broken = tmp_path / "source" / "0_orders_dataset.csv"
    broken.write_text("order_id,surprise\no1,x\n")
    job = dr.Job(spark, source, str(tmp_path / "stream"), Params(), clock=clock)
    for _ in range(2):  # the second start finds no new file
        ingest.stream_files(job, str(tmp_path / "cp"), files_per_batch=2).awaitTermination()
    for table in ("orders", "order_items"):
        assert lake_rows(spark, rows, job, table) == lake_rows(spark, rows, batch, table)
    assert spark.read.parquet(lake.quarantine_path(job.root, "orders")).count() == 1
    notes = spark.read.schema(lake.DRIFT_SCHEMA).parquet(f"{job.root}/quarantine/drift_log").collect()
    assert {r["table_name"] for r in notes} == {"orders"}
    # A batch that is repeated lands nothing twice.
    before = lake_rows(spark, rows, job, "orders")
    assert ingest.land_files(job, [str(p) for p in (tmp_path / "source").iterdir()], 0) is None
    assert spark.read.parquet(lake.quarantine_path(job.root, "orders")).count() == 1
    assert lake_rows(spark, rows, job, "orders") == before
    # A later file brings an order of a day that has landed.
    late = {**made["orders"][0], "order_id": "late", "order_purchase_timestamp": f"{rf.day(3)} 09:00:00"}
    rf.write(tmp_path / "more", {"orders": [late]})
    (tmp_path / "source" / "9_orders_dataset.csv").write_text(
        (tmp_path / "more" / rf.FILES["orders"]).read_text())
    ingest.stream_files(job, str(tmp_path / "cp"), files_per_batch=2).awaitTermination()
    landed = lake.read_raw(spark, job.root, "orders").filter("order_id = 'late'")
    assert sorted(r["ingest_date"] for r in landed.collect()) == [rf.day(3 + k) for k in range(4)]
    assert len(lake_rows(spark, rows, job, "orders")) == len(before) + 4


def test_a_streamed_order_that_moves_counts_once(spark, tmp_path):
    job, made = land_all(spark, tmp_path)
    feed.refresh_fact(job, feed.landed_keys(
        *(lake.read_raw(spark, job.root, t) for t in ("orders", "order_items"))))
    order = made["orders"][4]  # of day 1
    order["order_purchase_timestamp"] = f"{rf.day(8)} 12:00:00"
    source = rf.write(tmp_path / "source", made)
    window = dr.Window(rf.day(8), rf.day(9))
    dr.land_window(job, read_sources(spark, source), window)
    landed = [lake.read_raw(spark, job.root, t).filter(window.contains("ingest_date"))
              for t in ("orders", "order_items")]
    feed.refresh_fact(job, feed.landed_keys(*landed))
    fact = spark.read.schema(dr.FACT_SCHEMA).parquet(job.mart("fct_daily_sales")).collect()
    got = {(r["order_date"], r["product_id"]): (r["units"], r["revenue"]) for r in fact}
    assert got == rf.expected_fact(made) and dr.order_days(job).left() == []
