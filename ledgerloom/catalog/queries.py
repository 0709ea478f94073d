"""Every registered query: the plans of this package over the test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import to_double
from ledgerloom.operators import checks, history, slicing, upsert
from ledgerloom.operators.materialize import materialize, shared_dir
from ledgerloom.plans import daily_run, inventory, marts, sales, serving, staging
from ledgerloom.plans.ledger_state import LedgerState
from ledgerloom.plans.model_checks import model_checks, raw_checks
from ledgerloom.session import prepare
from ledgerloom.sinks.day_state import DayState
from ledgerloom.sinks.history_table import HistoryTable
from ledgerloom.sinks.publish import serving_projection
from ledgerloom.sinks.tables import write_days
from ledgerloom.sources import audit, files, lake, testbed
from ledgerloom.sources.seed import cost_ratios
from ledgerloom.streaming import feed, ingest

PARAMS, AS_OF, LOADED_AT = testbed.PARAMS, testbed.AS_OF, testbed.LOADED_AT
FACT_KEYS = ("order_date", "product_id")
# Daily sales whose products one task of the dense ledger takes.
SALES_PER_TASK = 20_000


class Models:
    """The models over the test tables, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.dir = sf_dir

    def raw(self, table: str) -> DataFrame:
        return getattr(testbed, f"raw_{table}")(self.spark, self.dir)

    def source_orders(self) -> DataFrame:
        return testbed.source_orders(self.spark, self.dir)

    def table(self, name: str) -> DataFrame:
        return testbed.table(self.spark, self.dir, name)

    def audit(self) -> DataFrame:
        return testbed.audit_runs(self.spark, self.dir)

    def attributes(self, products: str = "products") -> DataFrame:
        return sales.product_attributes(
            staging.stg_products(self.raw(products)),
            staging.stg_category_translation(self.raw("category_translation")),
            cost_ratios(self.spark, PARAMS), PARAMS)

    def enriched(self, items: str = "order_items", products: str = "products",
                 raw_items: DataFrame | None = None, headers: DataFrame | None = None) -> DataFrame:
        raw = self.raw(items) if raw_items is None else raw_items
        headers = staging.order_headers(self.raw("orders")) if headers is None else headers
        return sales.enriched_items(
            staging.order_lines(raw), headers, self.attributes(products), PARAMS)

    def daily(self) -> DataFrame:
        return sales.daily_product_sales(self.enriched())

    def stored_daily(self) -> DataFrame:
        return materialize(self.daily(), "daily_sales")

    def brand_daily(self, headers: DataFrame | None = None) -> DataFrame:
        """Daily sales per brand, stored because the ledger reads them twice.

        ``headers``: the order headers, where a caller has them.
        """
        lines = self.enriched("brand_items", "brand_products", headers=headers)
        return materialize(sales.daily_product_sales(lines), "brand_daily_sales")

    def fact(self) -> DataFrame:
        return marts.fct_daily_sales(self.daily())

    def early_fact(self) -> DataFrame:
        """The fact as it stood before the lines of the last 30 days came in, stored as a table."""
        newest = self.table("orders").agg(F.expr("max(date(o_orderdate))")).scalar()
        on_time = self.raw("order_items").filter(F.col("ingest_date") <= F.date_sub(newest, 30))
        daily = sales.daily_product_sales(self.enriched(raw_items=on_time))
        return materialize(marts.fct_daily_sales(daily), "early_fact")

    def fact_batch(self, target: DataFrame) -> DataFrame:
        """The fact's days inside the trailing window of ``target``, from the raw rows of these days.

        Orders are bounded by their partitions, which are never before an order's day, and lines by
        the orders that are left. Fact keys in the gap between the target's newest day and the
        window's start stay absent, as the window covers a few days only.
        """
        start = upsert.trailing_start(target, "order_date", PARAMS.late_reprocess_days).first()[0]
        headers = materialize(staging.order_headers(
            self.raw("orders").filter(F.col("ingest_date") >= F.lit(start))
        ).filter(F.col("order_date") >= F.lit(start)), "recent_headers")
        raw = self.raw("order_items").join(headers, "order_id", "left_semi")
        return marts.fct_daily_sales(sales.daily_product_sales(sales.enriched_items(
            staging.order_lines(raw), headers, self.attributes(), PARAMS)))

    def kpis(self) -> DataFrame:
        return marts.exec_kpis(self.fact())

    def by_category(self) -> DataFrame:
        return marts.sales_by_category(self.fact())

    def position(self) -> DataFrame:
        return inventory.inventory_position(self.brand_daily(), PARAMS)

    def health(self) -> DataFrame:
        return inventory.inventory_health_closed(self.brand_daily(), PARAMS)

    def status(self) -> DataFrame:
        return marts.run_status(self.audit(), self.fact(), AS_OF)


def _stg_order_items(m: Models) -> DataFrame:
    items = staging.stg_order_items(m.raw("order_items"))
    return items.withColumns({c: F.col(c).cast("double") for c in ("item_price", "freight_value")})


def _money_out(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns(dict(zip(names, to_double(*names))))


def _enriched_items(m: Models) -> DataFrame:
    return _money_out(m.enriched(), "revenue", "cogs", "gross_margin")


def _daily_product_sales(m: Models) -> DataFrame:
    return _money_out(m.daily(), "revenue", "cogs", "gross_margin")


def _inventory_grid(m: Models) -> DataFrame:
    return _money_out(inventory.inventory_grid(m.brand_daily()), "revenue")


def _inventory_position_product(m: Models) -> DataFrame:
    """The ledger of all products, one row per product and day, summed up by product and month."""
    daily = m.stored_daily()
    # A task holds the months of its products at once, so tasks grow in number, not in size.
    parts = -(-daily.count() // SALES_PER_TASK) or 1
    ledger = inventory.inventory_position(daily, PARAMS, parts=parts)
    month = F.trunc("inv_date", "month").alias("inv_month")
    sums = [F.sum(F.col(c).cast("bigint")).alias(c) for c in (
        "units_sold", "cum_units", "opening_stock", "restock_qty", "cum_replenishment", "on_hand",
        "on_hand_units", "reorder_point", "total_supply")]
    flags = [F.count_if(c).alias(c) for c in ("is_stockout_risk", "is_stockout", "is_overstock")]
    return ledger.groupBy("product_id", month).agg(
        F.count(F.lit(1)).alias("days"), *sums, *flags,
        F.max("days_of_supply").alias("days_of_supply"),
        F.max("sell_through_rate").alias("sell_through_rate"))


def _order_slice(m: Models) -> DataFrame:
    """Every source order on every day that re-scans it."""
    orders = m.source_orders()
    bounds = files.event_bounds(orders)
    return slicing.slice_orders(orders, bounds.select("first_day").scalar(),
                                bounds.select("last_day").scalar(), PARAMS.lookback_days)


def _source_items(m: Models) -> DataFrame:
    return m.raw("order_items").drop("ingest_date", "_ingest_date", "_loaded_at")


def _land_partitions(m: Models) -> DataFrame:
    return lake.stamp(_order_slice(m), LOADED_AT).select(
        "order_id", "order_status", "ingest_date", "_ingest_date", "_loaded_at")


def _items_for_slice(m: Models) -> DataFrame:
    items = slicing.slice_items(_source_items(m), _order_slice(m))
    return items.select("order_id", "order_item_id", "product_id", "seller_id", "price",
                        "ingest_date")


def _window(m: Models) -> DataFrame:
    return slicing.plan_window(files.event_bounds(m.source_orders()),
                               audit.watermark(m.audit()), PARAMS.max_days_per_run)


def _window_bounds(m: Models) -> list[Column]:
    """First and last day of the next run, read as one row; nulls when there is none."""
    days = _window(m).agg(F.min("business_day"), F.max("business_day")).first()
    return [F.lit(day).cast("date") for day in days]


def _dimension_daily_snapshot(m: Models) -> DataFrame:
    customers = m.table("customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    return slicing.daily_snapshot(customers, *_window_bounds(m))


def _rows_landed(m: Models) -> DataFrame:
    start, end = _window_bounds(m)
    orders = slicing.slice_orders(m.source_orders(), start, end, PARAMS.lookback_days)
    return slicing.rows_landed({
        "orders": orders,
        "order_items": slicing.slice_items(_source_items(m), orders),
        "products": slicing.daily_snapshot(m.table("part"), start, end),
        "customers": slicing.daily_snapshot(m.table("customer"), start, end),
    })


def _late_window_slice(m: Models) -> DataFrame:
    events = m.table("events").select("event_id", F.col("ts").cast("date").alias("event_day"))
    span = events.agg(F.struct(F.min("event_day").alias("a"), F.max("event_day").alias("z"))).scalar()
    return slicing.slice_days(events, F.col("event_day"), span.getField("a"), span.getField("z"),
                              PARAMS.lookback_days)


def _events_daily(m: Models) -> DataFrame:
    return feed.daily_totals(m.table("events"))


def _fact_upsert(m: Models) -> DataFrame:
    target = m.early_fact()
    return upsert.upsert(target, materialize(m.fact_batch(target), "fact_batch"), FACT_KEYS)


def _fact_upsert_twice(m: Models) -> DataFrame:
    target = m.early_fact()
    batch = materialize(m.fact_batch(target), "fact_batch")
    return upsert.upsert(upsert.upsert(target, batch, FACT_KEYS), batch, FACT_KEYS)


def _raw_lake_scan(m: Models) -> DataFrame:
    """A partitioned lake, one partition per month, whose early files lack the approval column."""
    path = f"{shared_dir(m.spark)}/ledgerloom/raw_lake-{uuid.uuid4().hex}"
    raw = m.raw("orders").select(
        "order_id", "order_status", "order_approved_at", "ingest_date",
        F.trunc("ingest_date", "month").alias("ingest_month"))
    early = F.col("ingest_date") < F.lit(dt.date(1998, 1, 1))
    for part in (raw.filter(early).drop("order_approved_at"), raw.filter(~early)):
        part.hint("rebalance", "ingest_month").write.mode("append").partitionBy(
            "ingest_month").parquet(path)
    return lake.scan_raw(m.spark, path).drop("ingest_month")


def _product_versions(m: Models) -> list[tuple[DataFrame, dt.datetime]]:
    """Three snapshots: new products, changed categories, vanished and returning products."""
    part = m.table("part").select(F.col("p_partkey").cast("string").alias("product_id"),
                                  F.col("p_type").alias("category_pt"), F.col("p_size").alias("size"))
    size = F.col("size")
    changed = F.when(size >= 40, "PROMO").when(size == 13, None).otherwise(F.col("category_pt"))
    versions = [
        (part.filter(size > 5), dt.datetime(2001, 8, 1)),
        (part.filter(size < 45).withColumn("category_pt", changed), dt.datetime(2001, 8, 2)),
        (part.filter(size > 2).withColumn("category_pt", changed), dt.datetime(2001, 8, 3)),
    ]
    return [(snapshot.drop("size"), at) for snapshot, at in versions]


def _scd2_products(m: Models) -> DataFrame:
    versions = _product_versions(m)
    state = history.empty_history(versions[0][0])
    for snapshot, at in versions:
        state = history.apply_snapshot(state, snapshot, "product_id", ["category_pt"], at)
    return state


def scratch(m: Models, name: str) -> str:
    """A new folder that all executors can reach."""
    return f"{shared_dir(m.spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"


def _latest_orders(m: Models) -> DataFrame:
    """The newest snapshot per order, from four batches out of order, the last one a replay."""
    raw = m.raw("orders")
    age = F.datediff("ingest_date", F.col("order_purchase_timestamp").cast("date"))
    path, keys = scratch(m, "latest_orders"), ("order_id",)
    for batch in (age >= 2, age == 0, age == 1, age >= 2):
        feed.merge_latest(raw.filter(batch), path, keys, staging.ORDER_TIES, 16)
    return feed.latest_table(m.spark, path, keys, staging.ORDER_TIES).read()


def _scd2_products_buckets(m: Models) -> DataFrame:
    """The snapshots of ``scd2_products`` on a stored history, the last one taken in twice."""
    table = HistoryTable(m.spark, scratch(m, "history"), "product_id", ("category_pt",),
                         "product_id string, category_pt string, valid_from timestamp_ntz, "
                         "valid_to timestamp_ntz", 16)
    for snapshot, at in [*_product_versions(m), _product_versions(m)[-1]]:
        table.apply(snapshot, at)
    return table.read()


def _late_events(m: Models) -> DataFrame:
    """Events in three batches, some held back to the last: daily totals and late rows per day."""
    events = m.table("events")
    day = F.dayofmonth("ts")
    held = F.col("event_id") % 97 == 0
    number = F.when(held, 2).otherwise(F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2))
    days = feed.ClosedDays(m.spark, scratch(m, "closed_days"), events.schema, "3 days")
    for batch in (0, 1, 2, 2):
        days.add(events.filter(number == batch), batch)
    on_time = days.totals(closed=True).unionByName(days.totals(closed=False))
    late = days.late().groupBy(F.col("ts").cast("date").alias("event_day"), "event_type").agg(
        F.count(F.lit(1)).alias("late_events"))
    return on_time.join(late, ["event_day", "event_type"], "full").select(
        "event_day", "event_type", F.coalesce("events", F.lit(0)).alias("events"),
        F.coalesce("total_value", F.lit(0.0)).alias("total_value"),
        F.coalesce("late_events", F.lit(0)).alias("late_events"))


def _in_two_steps(m: Models, df: DataFrame, path: str) -> Iterator[None]:
    """Write a day-partitioned table: nearly all days, some with too many units, then these and the rest."""
    units = "units_sold" if "units_sold" in df.columns else "units"
    odd, late = F.dayofmonth("order_date") > 27, F.dayofmonth("order_date") == 1
    write_days(df.withColumn(units, F.when(odd, F.col(units) + 7).otherwise(F.col(units)))
               .filter(~late), path, "order_date")
    yield
    write_days(df.filter(odd | late), path, "order_date")
    yield


def _ledger_state(m: Models) -> LedgerState:
    """The ledger's state of all products, brought up to date for changed and new days."""
    daily = m.stored_daily().select(
        "order_date", "product_id", F.col("units_sold").cast("bigint").alias("units_sold"),
        F.col("revenue").cast("decimal(28,2)").alias("revenue"))
    path = scratch(m, "sales_by_day")
    state = LedgerState(
        m.spark, scratch(m, "ledger_state"), path,
        "order_date date, product_id string, units_sold bigint, revenue decimal(28,2)", PARAMS)
    for _ in _in_two_steps(m, daily, path):
        state.refresh()
    return state


def _ledger_state_health(m: Models) -> DataFrame:
    return _ledger_state(m).health(m.attributes())


def _dq_ledger_product(m: Models) -> DataFrame:
    """Checks of the ledger and the health mart of all products, from the ledger's state."""
    state, attributes = _ledger_state(m), materialize(m.attributes(), "product_attributes")
    own = {name: [c for c in model_checks(PARAMS) if c.model == name]
           for name in ("int_inventory_position", "mart_inventory_health")}
    ledger = state.checks(own["int_inventory_position"], attributes)
    health = materialize(state.health(attributes), "product_health")
    return ledger.unionByName(checks.run_checks(
        "model", {"mart_inventory_health": health}, own["mart_inventory_health"]))


def _dq_fact_by_day(m: Models) -> DataFrame:
    """The fact's own checks, counted day by day and again only for days that changed."""
    fact, path = materialize(m.fact(), "fact"), scratch(m, "fact_by_day")
    own = [c for c in model_checks(PARAMS)
           if c.model == "fct_daily_sales" and c.kind != "references"]
    state = DayState(m.spark, scratch(m, "fact_checks"), f"order_date date, {checks.DAY_COUNTS}",
                     path, daily_run.FACT_SCHEMA, "order_date")
    for _ in _in_two_steps(m, fact, path):
        state.refresh(lambda days: checks.day_counts(days, "order_date", own))
    return checks.judge_days(state.read(), "model", own)


def _calendar(order: Column) -> Column:
    """A business day of a four-week calendar on which the orders of all years are placed."""
    return F.date_add(F.lit(dt.date(2001, 1, 1)), (order.cast("bigint") % 28).cast("int"))


def _calendar_orders(m: Models) -> DataFrame:
    day = _calendar(F.col("order_id"))
    return m.source_orders().withColumn(files.EVENT_TIME, day.cast("string")).withColumn(
        "ingest_date", day)


def _moved_orders_fact(m: Models) -> DataFrame:
    """The streamed fact after some orders have moved on by twenty days and more."""
    job = daily_run.Job(m.spark, "", scratch(m, "moved_orders"), PARAMS)
    orders = materialize(_calendar_orders(m), "calendar_orders")
    lines = m.raw("order_items").drop("ingest_date", "_ingest_date", "_loaded_at")
    moved = F.col("order_id").cast("bigint") % 11 == 0
    later = F.date_add("ingest_date", (20 + F.col("order_id").cast("bigint") % 3).cast("int"))
    corrected = orders.filter(moved).withColumn("ingest_date", later).withColumn(
        files.EVENT_TIME, F.col("ingest_date").cast("string"))
    for table in ("products", "customers", "category_translation"):
        raw = m.raw(table)
        raw.write.partitionBy("ingest_date").parquet(lake.raw_path(job.root, table))
    for batch, of_batch in ((orders, lines), (corrected, lines.filter(moved))):
        keys = batch.select("order_id", "ingest_date")
        # Corrected orders land beside those that are there already. There are few days, so each task
        # writes its rows of all of them.
        for table, rows in (("orders", batch), ("order_items", of_batch.join(keys, "order_id"))):
            lake.stamp(rows, LOADED_AT).write.mode("append").partitionBy("ingest_date").parquet(
                lake.raw_path(job.root, table))
        feed.refresh_fact(job, feed.landed_keys(
            keys.withColumn(files.EVENT_TIME, F.col("ingest_date").cast("string")),
            keys.limit(0)))
    return lake.read_table(m.spark, job.mart("fct_daily_sales"), daily_run.FACT_SCHEMA)


def _ingested_files(m: Models) -> DataFrame:
    """Order files streamed into the lake, two at a time; one breaks its contract and stays out."""
    source = scratch(m, "source_files")
    # Each file holds a week.
    orders = _calendar_orders(m).withColumn("week", F.floor(
        F.datediff("ingest_date", F.lit(dt.date(2001, 1, 1))) / 7).cast("int")).drop("ingest_date")
    for week in range(4):
        orders.filter(F.col("week") == week).drop("week").coalesce(1).write.option("header", True).csv(
            f"{source}/orders/week{week}")
    orders.drop("customer_id").coalesce(1).write.option("header", True).csv(f"{source}/orders/broken")
    patterns = dict(files.SOURCE_FILES) | {"orders": "orders/*.csv"}
    job = daily_run.Job(m.spark, source, scratch(m, "ingested"), PARAMS, patterns,
                        clock=lambda: dt.datetime.fromisoformat(LOADED_AT))
    ingest.stream_files(job, f"{job.root}/checkpoint", files_per_batch=2).awaitTermination()
    return lake.read_raw(m.spark, job.root, "orders").select(
        "order_id", "order_status", "ingest_date", "_ingest_date", "_loaded_at")


def _model_results(m: Models) -> DataFrame:
    """All model checks. Models that several others or their checks read are stored first."""
    orders = materialize(staging.stg_orders(m.raw("orders")), "stg_orders")
    headers = orders.select("order_id", "order_status", "order_date")
    items = materialize(staging.stg_order_items(m.raw("order_items")), "stg_order_items")
    attributes = materialize(m.attributes(), "product_attributes")
    enriched = materialize(sales.enriched_items(
        items.select("order_id", "order_item_id", "product_id", "item_price", "units"),
        headers, attributes, PARAMS), "enriched")
    daily = materialize(sales.daily_product_sales(enriched), "daily_sales")
    fact = marts.fct_daily_sales(daily)
    brand_daily = m.brand_daily(headers)
    models = {
        "seed_category_cost_ratio": cost_ratios(m.spark, PARAMS),
        "stg_orders": orders,
        "stg_order_items": items,
        "stg_products": staging.stg_products(m.raw("products")),
        "stg_customers": staging.stg_customers(m.raw("customers")),
        "stg_category_translation":
            staging.stg_category_translation(m.raw("category_translation")),
        "int_order_items_enriched": enriched,
        "int_daily_product_sales": daily,
        "int_inventory_position": inventory.inventory_position(brand_daily, PARAMS),
        "dim_product": marts.dim_product(attributes),
        "fct_daily_sales": fact,
        "mart_exec_kpis": marts.exec_kpis(fact),
        "mart_sales_by_category": marts.sales_by_category(fact),
        "mart_inventory_health": inventory.inventory_health_closed(brand_daily, PARAMS),
        "mart_pipeline_status": marts.run_status(m.audit(), fact, AS_OF),
    }
    return checks.run_checks("model", models, model_checks(PARAMS))


def _raw_results(m: Models) -> DataFrame:
    raw = testbed.raw_tables(m.spark, m.dir)
    return checks.run_checks("raw", raw, raw_checks(PARAMS))


QUERIES: dict[str, Callable[[Models], DataFrame]] = {
    # Staging
    "stg_orders": lambda m: staging.stg_orders(m.raw("orders")),
    "stg_order_items": _stg_order_items,
    "stg_products": lambda m: staging.stg_products(m.raw("products")),
    "stg_customers": lambda m: staging.stg_customers(m.raw("customers")),
    "stg_category_translation":
        lambda m: staging.stg_category_translation(m.raw("category_translation")),
    # Sales
    "enriched_items": _enriched_items,
    "daily_product_sales": _daily_product_sales,
    "dim_product": lambda m: marts.dim_product(m.attributes()),
    "fct_daily_sales": lambda m: m.fact(),
    "exec_kpis": lambda m: m.kpis(),
    "sales_by_category": lambda m: m.by_category(),
    # Inventory
    "date_spine": lambda m: inventory.date_spine(m.daily()),
    "stock_factor": lambda m: m.table("part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        inventory.stock_factor(F.col("p_partkey")).alias("stock_factor")),
    "inventory_grid": _inventory_grid,
    "inventory_position": lambda m: m.position(),
    "inventory_position_product": _inventory_position_product,
    "inventory_health": lambda m: m.health(),
    "inventory_health_product": lambda m: inventory.inventory_health_closed(m.stored_daily(), PARAMS),
    "inventory_status_breakdown": lambda m: serving.inventory_status_breakdown(m.health()),
    # Dashboard
    "kpi_headline": lambda m: serving.kpi_headline(m.kpis()),
    "revenue_margin_trend": lambda m: serving.revenue_margin_trend(
        m.kpis(), dt.date(1996, 1, 1), dt.date(2000, 12, 31)),
    "revenue_margin_trend_all": lambda m: serving.revenue_margin_trend(m.kpis()),
    "margin_by_category": lambda m: serving.margin_by_category(m.by_category()),
    "stockout_risk": lambda m: serving.stockout_risk(m.health()),
    "sell_through": lambda m: serving.sell_through(m.health()),
    "run_status": lambda m: m.status(),
    "status_tile": lambda m: serving.status_tile(m.status()),
    "publish_inventory_health": lambda m: serving_projection(m.health()),
    # Landing, window and history
    "event_bounds": lambda m: files.event_bounds(m.source_orders()),
    "watermark": lambda m: audit.watermark(m.audit()),
    "recent_runs": lambda m: audit.recent_runs(m.audit()),
    "plan_window": _window,
    "late_window_slice": _late_window_slice,
    "items_for_slice": _items_for_slice,
    "dimension_daily_snapshot": _dimension_daily_snapshot,
    "land_partitions": _land_partitions,
    "rows_landed": _rows_landed,
    "raw_lake_scan": _raw_lake_scan,
    "ingested_files": _ingested_files,
    "raw_row_counts": lambda m: lake.row_counts(testbed.raw_tables(m.spark, m.dir)),
    "fact_trailing_batch": lambda m: m.fact_batch(m.early_fact()),
    "fact_upsert": _fact_upsert,
    "fact_upsert_twice": _fact_upsert_twice,
    "scd2_products": _scd2_products,
    "scd2_products_buckets": _scd2_products_buckets,
    "events_daily": _events_daily,
    "late_events": _late_events,
    "latest_orders": _latest_orders,
    "moved_orders_fact": _moved_orders_fact,
    "ledger_state_health": _ledger_state_health,
    # Quality
    "dq_raw_gate": _raw_results,
    "dq_model_tests": _model_results,
    "dq_fact_by_day": _dq_fact_by_day,
    "dq_ledger_product": _dq_ledger_product,
    "dq_summary": lambda m: checks.summary(_model_results(m)),
    "source_freshness": lambda m: marts.source_freshness(
        m.raw("orders"), AS_OF, PARAMS.freshness_warn_hours, PARAMS.freshness_error_hours),
    "reconciliation": lambda m: marts.reconciliation(m.early_fact(), m.daily()),
}


def build(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](Models(spark, sf_dir))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(name, spark, sf_dir)

    return {name: runner(name) for name in QUERIES}
