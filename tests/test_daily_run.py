"""Whole runs on files: landing, gates, rebuilds, history, publishing and their failures."""

import copy
import datetime as dt
import shutil

import pytest
import retail_files as rf
from pyspark.sql import functions as F

from ledgerloom.operators.checks import CheckFailure
from ledgerloom.params import Params
from ledgerloom.plans import daily_run as dr
from ledgerloom.plans.marts import reconciliation
from ledgerloom.sinks import manifest, publish
from ledgerloom.sinks.tables import read_version, write_days, write_version
from ledgerloom.sources import audit, lake
from ledgerloom.sources.contracts import SchemaDrift, drift
from ledgerloom.sources.files import read_headers, read_source, source_dir

# The stock of so small a shop is not the subject here.
PARAMS = Params(min_opening_stock=1000)


@pytest.fixture
def shop(spark, tmp_path):
    made = rf.tables()
    source = rf.write(tmp_path / "source", made)
    job = dr.Job(spark, source, str(tmp_path / "warehouse"), PARAMS, clock=rf.Clock())
    return job, made, tmp_path


def fact(job):
    df = job.spark.read.schema(dr.FACT_SCHEMA).parquet(job.mart("fct_daily_sales"))
    rows = df.collect()
    got = {(r["order_date"], r["product_id"]): (r["units"], r["revenue"]) for r in rows}
    assert len(got) == len(rows)
    return got


def runs(job):
    rows = audit.read_audit(job.spark, job.root).orderBy("run_finished_at").collect()
    return [(r["mode"], r["status"]) for r in rows]


def watermark(job):
    return dr.status(job)[0].first()["last_loaded_date"]


def test_source_text_is_kept(shop):
    job, _, _ = shop
    orders = read_source(job.spark, job.source_dir, "orders")
    row = orders.first()
    assert (row["order_approved_at"], row["order_delivered_customer_date"]) == (None, "NA")
    assert {t for _, t in orders.dtypes} == {"string"}
    with pytest.raises(FileNotFoundError, match="orders"):
        read_source(job.spark, source_dir(job.source_dir, sample=True), "orders")


def test_large_files_are_split_where_no_value_has_a_line_break(shop):
    job, made, _ = shop
    job.spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        whole, split = (read_source(job.spark, job.source_dir, "orders", multi_line=m)
                        for m in (True, False))
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert split.count() == len(made["orders"]) and split.exceptAll(whole).count() == 0
    finally:
        job.spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_daily_runs_to_the_end_of_the_source(shop):
    job, made, tmp = shop
    exports = str(tmp / "exports")
    first = dr.run(job, publisher=lambda marts: publish.export_csv(marts, exports))
    assert (first.status, first.tests_passed) == ("PASS", 54)
    assert (first.window.start, first.window.end) == (rf.day(0), rf.day(6))
    assert fact(job) == rf.expected_fact(made, 7)

    # An order of a past day is canceled, another one is late, and a category changes.
    late = copy.deepcopy(made)
    late["orders"][4 * 5]["order_status"] = "canceled"
    late["orders"].append({**late["orders"][0], "order_id": "late",
                           "order_purchase_timestamp": f"{rf.day(5)} 09:00:00"})
    late["order_items"].append({**late["order_items"][0], "order_id": "late"})
    late["products"][0]["product_category_name"] = "beleza_saude"
    late["products"] = late["products"][:2] + late["products"][3:]
    rf.write(tmp / "source", late)
    second = dr.run(job, publisher=lambda marts: publish.export_csv(marts, exports))
    assert (second.window.start, second.window.end) == (rf.day(7), rf.day(9))
    assert fact(job) == rf.expected_fact(late)
    assert watermark(job) == rf.day(9)

    assert dr.run(job).status == "NOOP"
    assert runs(job) == [("incremental", "PASS"), ("incremental", "PASS"), ("incremental", "NOOP")]

    spark = job.spark
    tile = spark.read.parquet(job.mart("mart_pipeline_status")).first()
    assert (tile["pipeline_health"], tile["tests_passed"]) == ("PASSING", 54)
    assert tile["data_through_date"] == rf.day(9)

    history = dr.product_history(job).read()
    of_p0 = history.filter("product_id = 'p0'").orderBy("valid_from").collect()
    assert [r["category_pt"] for r in of_p0] == ["cama_mesa_banho", "beleza_saude"]
    assert of_p0[0]["valid_to"] == of_p0[1]["valid_from"] and of_p0[1]["valid_to"] is None
    # The lake still knows the product the source dropped, so its row stays open.
    assert history.filter("product_id = 'p2' AND valid_to IS NULL").count() == 1

    health = spark.read.parquet(job.mart("mart_inventory_health")).collect()
    names = {r["product_id"]: r["category_en"] for r in health}
    assert names == {"p0": "beauty", "p1": "beauty", "p2": "sem_par", "p3": "unknown"}

    kpis = spark.read.parquet(job.mart("mart_exec_kpis")).collect()
    want = rf.expected_fact(late)
    for row in kpis:
        days = [v for (d, _), v in want.items() if d == row["order_date"]]
        assert (row["active_skus"], row["units"]) == (len(days), sum(u for u, _ in days))
    assert len(kpis) == rf.DAYS

    for name in publish.PUBLISHED:
        exported = spark.read.option("header", True).csv(f"{exports}/{name.upper()}")
        assert exported.count() == spark.read.parquet(job.mart(name)).count()

    # A backfill repeats days without counting twice and leaves the watermark alone.
    before = fact(job)
    again = dr.backfill(job, rf.day(2), rf.day(4))
    assert (again.window.start, again.window.end) == (rf.day(2), rf.day(4))
    assert fact(job) == before and watermark(job) == rf.day(9)

    assert dr.full_refresh(job) == 53
    assert fact(job) == before
    daily = lake.read_table(spark, job.model("daily_sales"), dr.DAILY_SCHEMA)
    assert reconciliation(spark.read.parquet(job.mart("fct_daily_sales")), daily).count() == 0


def test_a_moved_order_ends_on_one_day(shop):
    """An order of the first run is corrected to a day far beyond the look-back."""
    job, made, tmp = shop
    dr.run(job)
    moved = copy.deepcopy(made)
    moved["orders"][0]["order_purchase_timestamp"] = f"{rf.day(9)} 12:00:00"
    rf.write(tmp / "source", moved)
    read = []
    real = dr.DayState.refresh
    try:
        dr.DayState.refresh = lambda self, derive: read.append(real(self, derive)) or read[-1]
        dr.run(job)
    finally:
        dr.DayState.refresh = real
    assert fact(job) == rf.expected_fact(moved)
    # Days that neither a run nor a moved order touches are not derived again.
    assert all(rf.day(0) in days and rf.day(2) not in days for days in read) and len(read) == 4
    before = fact(job)
    assert dr.full_refresh(job) == 53 and fact(job) == before
    daily = lake.read_table(job.spark, job.model("daily_sales"), dr.DAILY_SCHEMA)
    assert reconciliation(job.spark.read.parquet(job.mart("fct_daily_sales")), daily).count() == 0


def test_of_two_runs_one_stops(shop):
    job, _, _ = shop
    with manifest.writing(job.spark, f"{job.root}/meta/run", "run abc", job.clock()):
        with pytest.raises(manifest.ConcurrentWrite, match="run abc has been writing"):
            dr.run(job)
    assert runs(job) == [] and lake.read_raw(job.spark, job.root, "orders").count() == 0


def test_key_and_window_mode_differ_on_a_vanished_key(spark, tmp_path):
    made = rf.tables()
    gone = copy.deepcopy(made)
    # The only orders of day 6 with p2 are canceled after the first run.
    for order in gone["orders"]:
        if order["order_id"].startswith("o6_") and order["order_status"] != "canceled":
            order["order_status"] = "canceled"
    for mode in ("key", "window"):
        source = rf.write(tmp_path / mode, made)
        job = dr.Job(spark, source, f"{source}/warehouse", PARAMS, fact_mode=mode, clock=rf.Clock())
        dr.run(job)
        rf.write(tmp_path / mode, gone)
        dr.run(job)
        kept = {key: v for key, v in rf.expected_fact(made).items() if key[0] == rf.day(6)}
        want = rf.expected_fact(gone) | (kept if mode == "key" else {})
        assert fact(job) == want


def test_drift_is_quarantined_before_anything_lands(shop):
    job, made, tmp = shop
    for row in made["products"]:
        row["surprise"] = "1"
    rf.write(tmp / "source", made)
    with pytest.raises(SchemaDrift, match="products: column surprise is unknown"):
        dr.run(job)
    assert runs(job) == [("incremental", "FAIL")] and watermark(job) is None
    assert job.spark.read.parquet(lake.quarantine_path(job.root, "products")).count() == 4
    notes = job.spark.read.schema(lake.DRIFT_SCHEMA).parquet(f"{job.root}/quarantine/drift_log")
    assert [r["table_name"] for r in notes.collect()] == ["products"]
    assert lake.read_raw(job.spark, job.root, "orders").count() == 0


def test_bad_rows_fail_the_gate_and_a_mended_source_recovers(shop):
    job, made, tmp = shop
    broken = copy.deepcopy(made)
    broken["order_items"][0]["price"] = "-5"
    broken["order_items"][1]["freight_value"] = "dear"
    broken["orders"][3]["order_status"] = "lost"
    rf.write(tmp / "source", broken)
    with pytest.raises(CheckFailure, match="3 checks failed"):
        dr.run(job)
    assert runs(job) == [("incremental", "FAIL")] and watermark(job) is None
    rf.write(tmp / "source", made)
    assert dr.run(job).window.start == rf.day(0)
    assert fact(job) == rf.expected_fact(made, 7)


def test_orders_without_a_time_are_set_aside(shop):
    job, made, tmp = shop
    made["orders"].append({**made["orders"][0], "order_id": "odd",
                           "order_purchase_timestamp": "soon"})
    rf.write(tmp / "source", made)
    assert dr.run(job).status == "PASS"
    odd = job.spark.read.parquet(lake.quarantine_path(job.root, "orders"))
    assert [r["order_id"] for r in odd.collect()] == ["odd"]


def test_landing_again_replaces_a_day(shop):
    job, made, tmp = shop
    window = dr.Window(rf.day(0), rf.day(4))

    def land():
        from ledgerloom.sources.files import read_sources
        return dr.land_window(job, read_sources(job.spark, job.source_dir), window)

    def per_day():
        raw = lake.read_raw(job.spark, job.root, "orders")
        return {r[0]: r[1] for r in raw.groupBy("ingest_date").count().collect()}

    assert land() == land()
    assert per_day() == {rf.day(d): 4 * min(d + 1, 4) for d in range(5)}
    made["orders"] = [o for o in made["orders"] if not o["order_id"].startswith("o0_")]
    rf.write(tmp / "source", made)
    land()
    assert per_day() == {rf.day(d): 4 * min(d, 4) if d < 4 else 16 for d in range(1, 5)}


def test_partitions_of_different_columns_are_united(spark, tmp_path):
    root = str(tmp_path)
    old = spark.createDataFrame([("a", "x", dt.date(2020, 1, 1))],
                                "product_id string, product_category_name string, ingest_date date")
    new = old.selectExpr("'b' AS product_id", "'y' AS product_category_name",
                         "'9' AS product_weight_g", "DATE '2020-01-02' AS ingest_date")
    for df in (old, new):
        lake.land(df, lake.raw_path(root, "products"), "2020-01-03 00:00:00")
    for raw in (lake.read_raw(spark, root, "products"),
                lake.scan_raw(spark, lake.raw_path(root, "products"))):
        weights = {r["product_id"]: r["product_weight_g"] for r in raw.collect()}
        assert weights == {"a": None, "b": "9"}
    pruned = lake.read_raw(spark, root, "products", dt.date(2020, 1, 2))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert [r["product_id"] for r in pruned.collect()] == ["b"]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_version(spark, path, "id bigint").count() == 0
    for n in range(1, 4):
        seen = read_version(spark, path, "id bigint")
        write_version(seen.unionByName(spark.range(n)), path)
    assert sorted(p.name for p in (tmp_path / "table").iterdir()) == ["v0000000002", "v0000000003"]
    spark.range(99).write.parquet(f"{path}/v0000000004")
    (tmp_path / "table" / "v0000000004" / "_SUCCESS").unlink()
    assert read_version(spark, path, "id bigint").count() == 6
    assert write_version(spark.range(1), path).count() == 1


def test_serving_projection(spark):
    mart = spark.createDataFrame([("a", True, None)], "product_id string, x boolean, y boolean")
    served = publish.serving_projection(mart, upper=True)
    assert served.columns == ["PRODUCT_ID", "X", "Y"]
    assert tuple(served.first()) == ("a", 1, None)


def test_missing_marts_are_skipped(spark, tmp_path):
    assert publish.read_marts(spark, str(tmp_path)) == {}


def test_a_lost_mart_and_a_broken_day_do_not_stay(shop):
    job, made, tmp = shop
    dr.run(job)
    # A write that died left no mart; the next run has all days again.
    shutil.rmtree(f"{job.root}/marts/mart_exec_kpis")
    dr.run(job)
    days = {d for d, _ in rf.expected_fact(made)}
    kpis = job.spark.read.parquet(job.mart("mart_exec_kpis")).collect()
    assert {r["order_date"] for r in kpis} == days and len(kpis) == len(days)

    # An old day of the fact breaks after it was checked: a later run finds it.
    path = job.mart("fct_daily_sales")
    day = lake.read_table(job.spark, path, dr.FACT_SCHEMA).filter(f"order_date = '{rf.day(0)}'")
    broken = job.spark.createDataFrame(day.collect(), day.schema).withColumn("units", -F.col("units"))
    write_days(broken, path, "order_date")
    made["orders"].append({**made["orders"][-1], "order_id": "new",
                           "order_purchase_timestamp": f"{rf.day(10)} 09:00:00"})
    made["order_items"].append({**made["order_items"][-1], "order_id": "new"})
    rf.write(tmp / "source", made)
    with pytest.raises(CheckFailure):
        dr.run(job)


def test_marts_of_other_days_than_the_fact_raise(spark):
    fact = spark.sql("SELECT DATE '2020-01-01' AS order_date, 1L AS units, 2.0D AS revenue")
    daily = spark.sql("SELECT DATE '2020-01-01' AS order_date, 1L AS units_sold, "
                      "CAST(2 AS decimal(28,2)) AS revenue")
    dr.check_days(fact, daily, {"mart": fact}, exact=True)
    with pytest.raises(CheckFailure, match="mart and the fact differ in 1 days"):
        dr.check_days(fact, daily, {"mart": fact.limit(0)}, exact=False)
    other = daily.withColumn("units_sold", F.lit(5))
    with pytest.raises(CheckFailure, match="disagree on 1 days"):
        dr.check_days(fact, other, {}, exact=True)
    dr.check_days(fact, other, {}, exact=False)


def test_quoted_line_breaks_and_headers_of_all_files(spark, tmp_path):
    (tmp_path / "a_customers_dataset.csv").write_text(
        'customer_id,customer_unique_id,customer_state,customer_city\nc1,u1,SP,"a\nb"\nc2,u2,SP,NA\n')
    (tmp_path / "b_customers_dataset.csv").write_text(
        "customer_id,customer_state,customer_unique_id\nc3,RJ,u3\n")
    got = {tuple(r) for r in read_source(spark, str(tmp_path), "customers").select(
        "customer_id", "customer_unique_id", "customer_state", "customer_city").collect()}
    assert got == {("c1", "u1", "SP", "a\nb"), ("c2", "u2", "SP", "NA"), ("c3", "u3", "RJ", None)}
    headers = read_headers(spark, str(tmp_path), "customers").values()
    assert [f.column for f in drift("customers", headers)] == ["customer_city"]


def test_one_drifted_file_of_two_stops_the_run(shop):
    job, made, tmp = shop
    (tmp / "source" / "more_products_dataset.csv").write_text("product_id\np9\n")
    with pytest.raises(SchemaDrift, match="products: column product_category_name is missing"):
        dr.run(job)
    assert lake.read_raw(job.spark, job.root, "orders").count() == 0


def test_a_second_quarantine_of_a_day_keeps_the_first(spark, tmp_path):
    for run_id in ("r1", "r2"):
        lake.quarantine(spark.createDataFrame([(run_id,)], "x string"), str(tmp_path), "orders",
                        rf.day(0), ["odd"], rf.Clock()(), run_id)
    kept = spark.read.parquet(lake.quarantine_path(str(tmp_path), "orders")).collect()
    assert {r["x"] for r in kept} == {"r1", "r2"}
