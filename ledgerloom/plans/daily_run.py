"""The daily run and the backfill: from source files to published marts.

Order of a run: check all contracts, plan the days, land them, gate the raw rows, rebuild the
affected days of the models, check the models, publish, and last of all append the PASS row.
The watermark is derived from that row, so a run that stops anywhere before it is repeated as a
whole, and every step may be repeated without counting anything twice.

Staging, enrichment and the fact are rebuilt for the affected days only: raw partitions before the
first of them are pruned, and dimensions are merged into a stored current version. A day that an order
has left is rebuilt, too, however old. Executive marts, daily totals, the fact's checks and the ledger
are derived anew for days whose files differ from the last run's, so a day that breaks after it was
built is found by the next run, and no other day is read. The raw gate reads the whole lake.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field, replace as with_fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import checks, slicing
from ledgerloom.operators.conform import conform
from ledgerloom.operators.dedup import latest_wins
from ledgerloom.operators.materialize import materialize
from ledgerloom.operators.upsert import trailing_start, upsert
from ledgerloom.params import Params
from ledgerloom.plans import marts, sales, staging
from ledgerloom.plans.ledger_state import LedgerState
from ledgerloom.plans.model_checks import (
    mart_checks, parse_checks, raw_checks, sales_checks, staging_checks, status_checks,
)
from ledgerloom.plans.order_days import OrderDays
from ledgerloom.session import prepare
from ledgerloom.sinks import manifest, publish
from ledgerloom.sinks.day_state import DayState
from ledgerloom.sinks.history_table import HistoryTable
from ledgerloom.sinks.tables import (
    day_files, drop_days, read_version, store, write_days, write_version,
)
from ledgerloom.sources import audit, contracts, files, lake
from ledgerloom.sources.seed import cost_ratios

log = logging.getLogger(__name__)

FACT_KEYS = ("order_date", "product_id")
FACT_SCHEMA = ("order_date date, product_id string, category_pt string, category_en string, "
               "units bigint, revenue double, cogs double, gross_margin double, margin_pct double")
DAILY_SCHEMA = ("order_date date, product_id string, units_sold bigint, revenue decimal(28,2), "
                "cogs decimal(38,2), gross_margin decimal(38,2)")
HISTORY_SCHEMA = ("product_id string, category_pt string, valid_from timestamp_ntz, "
                  "valid_to timestamp_ntz")

KPI_SCHEMA = ("order_date date, active_skus bigint, units bigint, revenue double, "
              "gross_margin double, margin_pct double")
CATEGORY_SCHEMA = ("order_date date, category_en string, units bigint, revenue double, "
                   "cogs double, gross_margin double, margin_pct double")
TOTAL_SCHEMA = "order_date date, units_sold bigint, revenue decimal(38,2)"

# Key and tie-break columns of the dimensions kept in a stored current version.
DIMENSIONS = {
    "products": (("product_id",), staging.PRODUCT_TIES),
    "customers": (("customer_id",), staging.CUSTOMER_TIES),
    "category_translation": (("product_category_name",), staging.TRANSLATION_TIES),
}


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


@dataclass(frozen=True)
class Job:
    """Where a run reads and writes, and the rules it applies.

    ``multi_line=False`` lets Spark split large source files; no value may hold a line break then.
    """

    spark: SparkSession
    source_dir: str
    root: str
    params: Params = field(default_factory=Params)
    source_files: Mapping[str, str] = field(default_factory=lambda: dict(files.SOURCE_FILES))
    fact_mode: str = "key"
    multi_line: bool = True
    clock: Callable[[], dt.datetime] = utc_now

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name}"


@dataclass(frozen=True)
class Window:
    start: dt.date
    end: dt.date

    def contains(self, column: str):
        return F.col(column).between(F.lit(self.start), F.lit(self.end))

    def days(self) -> list[dt.date]:
        return [self.start + dt.timedelta(days=n) for n in range((self.end - self.start).days + 1)]


@dataclass(frozen=True)
class Outcome:
    status: str
    window: Window | None = None
    rows: int = 0
    tests_passed: int = 0
    tests_failed: int = 0


def check_contracts(job: Job, sources: Mapping[str, DataFrame], day: dt.date,
                    run_id: str) -> None:
    """Compare the header of every file with its table's contract before anything lands."""
    findings = [f for t in sources for f in contracts.drift(t, files.read_headers(
        job.spark, job.source_dir, t, job.source_files).values())]
    for table in dict.fromkeys(f.table for f in findings):
        lake.quarantine(sources[table], job.root, table, day,
                        [f for f in findings if f.table == table], job.clock(), run_id)
    if findings:
        raise contracts.SchemaDrift("; ".join(f"{f.table}: {f}" for f in findings))


def plan(job: Job, bounds: DataFrame, start: dt.date | None = None,
         end: dt.date | None = None) -> Window | None:
    """Days of the next run. The cap on days holds unless both ends are given."""
    days = slicing.plan_window(
        bounds, audit.watermark(audit.read_audit(job.spark, job.root)),
        job.params.max_days_per_run, start, end)
    first, last = days.agg(F.min("business_day"), F.max("business_day")).first()
    return None if first is None else Window(first, last)


def set_aside_unreadable(job: Job, orders: DataFrame, day: dt.date, run_id: str) -> None:
    """Quarantine orders without a readable time; they belong to no day and would be lost."""
    lake.quarantine(orders.filter(files.event_date().isNull()), job.root, "orders", day,
                    [f"unreadable {files.EVENT_TIME}"], job.clock(), run_id)


def land_window(job: Job, sources: Mapping[str, DataFrame], window: Window) -> int:
    """Land all tables for all days of the window; return the rows landed.

    Landing alone moves no watermark.
    """
    spark, root = job.spark, job.root
    loaded_at = job.clock().strftime("%Y-%m-%d %H:%M:%S")
    lookback = job.params.lookback_days

    def write(table: str, df: DataFrame) -> None:
        path = lake.raw_path(root, table)
        before = day_files(spark, path, "ingest_date", window.days())
        lake.land(df, path, loaded_at)
        after = day_files(spark, path, "ingest_date", window.days())
        # A partition that still has the files it had got no rows this time.
        drop_days(spark, path, "ingest_date", [d for d in after if after[d] == before.get(d)])

    write("orders", slicing.slice_orders(sources["orders"], window.start, window.end, lookback))
    landed_orders = lake.read_raw(spark, root, "orders").filter(window.contains("ingest_date"))
    write("order_items", slicing.slice_items(
        sources["order_items"], landed_orders.select("order_id", "ingest_date")))
    for table in DIMENSIONS:
        write(table, slicing.daily_snapshot(sources[table], window.start, window.end))

    landed = {t: lake.read_raw(spark, root, t).filter(window.contains("ingest_date"))
              for t in sources}
    total = slicing.rows_landed(landed).agg(F.sum("row_count")).first()[0]
    return total or 0


def gate_raw(job: Job) -> None:
    """Check the raw tables, all partitions of them; raise on any failure."""
    raw = {t: lake.read_raw(job.spark, job.root, t) for t in contracts.CONTRACTS}
    params = job.params
    checks.raise_on_failure(checks.run_checks(
        "raw", raw, [*raw_checks(params), *parse_checks()], params.warn_only))
    now = job.clock()
    for table, df in raw.items():
        age = marts.source_freshness(df, now, params.freshness_warn_hours,
                                     params.freshness_error_hours).first()
        if age["status"] == "error":
            raise checks.CheckFailure(f"{table} was last loaded at {age['newest_loaded_at']}")


def current_dimension(job: Job, table: str, window: Window | None,
                      relanded: bool = True) -> DataFrame:
    """Newest raw row per key over all snapshots of a dimension.

    Only snapshots newer than the stored current version are merged into it. Where the window
    may have replaced snapshots it has already seen, it is rebuilt from the lake instead.
    """
    keys, ties = DIMENSIONS[table]
    path = job.model(f"current_{table}")
    columns = [*keys, *ties, "_ingest_date", "_loaded_at"]
    raw = lake.read_raw(job.spark, job.root, table)
    stored = read_version(job.spark, path, raw.select(*columns).schema)
    newest = stored.agg(F.max("_ingest_date")).first()[0]
    if newest is None or window is None or (relanded and newest >= window.start.isoformat()):
        rows = raw
    elif newest >= window.end.isoformat():
        return stored
    else:
        unseen = raw.filter(F.col("ingest_date") > F.lit(newest).cast("date"))
        rows = stored.unionByName(unseen.select(*columns))
    return write_version(latest_wins(rows.select(*columns), keys, ties), path)


def build_dimensions(job: Job, window: Window | None, relanded: bool = True
                     ) -> tuple[dict[str, DataFrame], DataFrame]:
    """The staged dimensions and the stored attributes of every product."""
    current = {t: current_dimension(job, t, window, relanded) for t in DIMENSIONS}
    staged = {
        "seed_category_cost_ratio": cost_ratios(job.spark, job.params),
        "stg_products": staging.stg_products(current["products"]),
        "stg_customers": staging.stg_customers(current["customers"]),
        "stg_category_translation":
            staging.stg_category_translation(current["category_translation"]),
    }
    attributes = store(
        sales.product_attributes(staged["stg_products"], staged["stg_category_translation"],
                                 staged["seed_category_cost_ratio"], job.params),
        job.model("product_attributes"))
    return staged, attributes


def product_history(job: Job) -> HistoryTable:
    """The history of the products' categories."""
    return HistoryTable(job.spark, job.model("product_history"), "product_id", ("category_pt",),
                        HISTORY_SCHEMA)


def reprocess_from(job: Job, window: Window | None) -> dt.date | None:
    """First business day to rebuild; None rebuilds all."""
    fact = lake.read_table(job.spark, job.mart("fct_daily_sales"), FACT_SCHEMA)
    if window is None or fact.isEmpty():
        return None
    first_landed = window.start - dt.timedelta(days=job.params.lookback_days)
    return trailing_start(fact, "order_date", job.params.late_reprocess_days,
                          first_landed).first()[0]


def _from(df: DataFrame, column: str, since: dt.date | None) -> DataFrame:
    return df if since is None else df.filter(F.col(column) >= F.lit(since))


def _write_model_days(job: Job, df: DataFrame, path: str, since: dt.date | None,
                      schema: str) -> DataFrame:
    """Replace all days from ``since`` on, also those that no longer have a row."""
    before = _from(lake.read_table(job.spark, path, schema), "order_date", since)
    gone = before.select("order_date").distinct().join(df, "order_date", "left_anti")
    emptied = [r[0] for r in gone.collect()]
    write_days(df, path, "order_date")
    drop_days(job.spark, path, "order_date", emptied)
    return lake.read_table(job.spark, path, schema)


def check_days(kpis: DataFrame, sold: DataFrame, built: Mapping[str, DataFrame],
               exact: bool) -> None:
    """Raise unless marts and daily sales have the fact's days, units and revenue.

    All of them have a row or a few per day: ``kpis`` of the fact, ``sold`` of the daily sales,
    ``built`` other marts. With ``exact`` false the fact may keep keys that left the sales (updates by
    key), and days on which it differs are logged.
    """
    days = kpis.select("order_date").distinct()
    for name, mart in built.items():
        other = mart.select("order_date").distinct()
        odd = days.exceptAll(other).unionByName(other.exceptAll(days)).count()
        if odd:
            raise checks.CheckFailure(f"{name} and the fact differ in {odd} days")
    differing = marts.reconciliation(kpis, sold).count()
    if differing and exact:
        raise checks.CheckFailure(f"the fact and the daily sales disagree on {differing} days")
    if differing:
        log.warning("the fact and the daily sales disagree on %d days", differing)


def _as_daily(batch: DataFrame) -> DataFrame:
    """Daily sales as the ledger reads them, in the types of ``DAILY_SCHEMA``."""
    return batch.select(
        "order_date", "product_id", "units_sold", F.col("revenue").cast("decimal(28,2)"),
        *[F.col(c).cast("decimal(38,2)") for c in ("cogs", "gross_margin")])


def build_sales(job: Job, since: dt.date | None, attributes: DataFrame,
                stored: dict[str, DataFrame]) -> tuple[int, DataFrame]:
    """Rebuild the sales days from ``since`` on; return checks passed and the refreshed fact.

    A snapshot of an order lies in the partition of its own day or in a later one, so the
    partitions from ``since`` on hold the newest version of every order of these days.
    """
    spark, root = job.spark, job.root
    orders = stored["stg_orders"] = store(
        staging.stg_orders(lake.read_raw(spark, root, "orders", since)), job.model("stg_orders"))
    items = stored["stg_order_items"] = store(
        staging.stg_order_items(lake.read_raw(spark, root, "order_items", since)),
        job.model("stg_order_items"))
    enriched = stored["int_order_items_enriched"] = store(
        sales.enriched_items(
            items.select("order_id", "order_item_id", "product_id", "item_price", "units"),
            orders.select("order_id", "order_status", "order_date"), attributes, job.params),
        job.model("order_items_enriched"))
    batch = stored["int_daily_product_sales"] = store(
        sales.daily_product_sales(_from(enriched, "order_date", since)),
        job.model("daily_sales_batch"))
    results = checks.run_checks("model", stored,
                                [*staging_checks(job.params), *sales_checks()],
                                job.params.warn_only)
    passed = checks.raise_on_failure(results)[0]

    stored["daily_sales"] = _write_model_days(
        job, _as_daily(batch), job.model("daily_sales"), since, DAILY_SCHEMA)

    path = job.mart("fct_daily_sales")
    fresh = conform(marts.fct_daily_sales(batch), "fct_daily_sales")
    if since is None or job.fact_mode == "window":
        return passed, _write_model_days(job, fresh, path, since, FACT_SCHEMA)
    target = _from(lake.read_table(spark, path, FACT_SCHEMA), "order_date", since)
    write_days(upsert(target, fresh, FACT_KEYS), path, "order_date")
    return passed, lake.read_table(spark, path, FACT_SCHEMA)


def order_days(job: Job) -> OrderDays:
    """The business day on which each order counts."""
    return OrderDays(job.spark, job.model("order_days"))


def rebuild_days(job: Job, days: Collection[dt.date], attributes: DataFrame,
                 exact: Collection[dt.date] = ()) -> None:
    """Rebuild the daily sales and the fact of single days, each from its own partitions.

    The snapshots of a day's orders lie in the day's partition and those of the days that re-scan
    it, and order lines land with their order. An order that has moved on to another day is told by
    the index of order days. On ``exact`` days the fact keeps no key that left the sales.
    """
    spark, lookback = job.spark, job.params.lookback_days
    if not days:
        return
    partitions = sorted({d + dt.timedelta(days=n) for d in days for n in range(lookback + 1)})

    def raw(table: str) -> DataFrame:
        return lake.read_raw(spark, job.root, table).filter(F.col("ingest_date").isin(partitions))

    def of_days(df: DataFrame) -> DataFrame:
        return df.filter(F.col("order_date").isin(list(days)))

    headers = materialize(of_days(staging.order_headers(raw("orders"))), "day_headers")
    index = order_days(job)
    if index.exists():
        headers = index.counting(headers)
    enriched = sales.enriched_items(
        staging.order_lines(raw("order_items")), headers, attributes, job.params)
    batch = store(sales.daily_product_sales(enriched), job.model("daily_sales_days"))
    fresh = conform(marts.fct_daily_sales(batch), "fct_daily_sales")
    path = job.mart("fct_daily_sales")
    if job.fact_mode != "window":
        target = of_days(lake.read_table(spark, path, FACT_SCHEMA))
        fresh = upsert(target.filter(~F.col("order_date").isin(list(exact))), fresh, FACT_KEYS)
    for df, where, schema in ((_as_daily(batch), job.model("daily_sales"), DAILY_SCHEMA),
                              (fresh, path, FACT_SCHEMA)):
        had = {r[0] for r in of_days(lake.read_table(spark, where, schema))
               .select("order_date").distinct().collect()}
        has = {r[0] for r in df.select("order_date").distinct().collect()}
        write_days(df, where, "order_date")
        drop_days(spark, where, "order_date", sorted(had - has))


def _day_state(job: Job, name: str, schema: str, of_fact: bool, tag: str = "") -> DayState:
    """A few rows per day that follow from the stored fact or daily sales."""
    source = (job.mart("fct_daily_sales"), FACT_SCHEMA) if of_fact else (
        job.model("daily_sales"), DAILY_SCHEMA)
    return DayState(job.spark, job.model(name), schema, *source, "order_date", tag)


def day_totals(daily: DataFrame) -> DataFrame:
    """Units and revenue of daily sales per day."""
    return daily.groupBy("order_date").agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"))


def fact_checks() -> list[checks.Check]:
    """The fact's checks that its days decide one by one."""
    return [c for c in mart_checks() if c.model == "fct_daily_sales" and c.kind != "references"]


def refresh_fact_checks(job: Job) -> DataFrame:
    """Results of the fact's own checks: changed days are counted anew, all days judged."""
    own = fact_checks()
    state = _day_state(job, "fact_checks", f"order_date date, {checks.DAY_COUNTS}", of_fact=True,
                       tag=",".join(c.name for c in own))
    state.refresh(lambda days: checks.day_counts(days, "order_date", own))
    return checks.judge_days(state.read(), "model", own, job.params.warn_only)


def ledger_state(job: Job) -> LedgerState:
    return LedgerState(job.spark, job.model("ledger_state"), job.model("daily_sales"), DAILY_SCHEMA,
                       job.params)


def refresh_day_marts(job: Job) -> tuple[DataFrame, DataFrame, DataFrame]:
    """KPIs, sales by category and daily totals, derived anew for changed days only."""
    made = []
    for name, schema, of_fact, derive in (
            ("kpi_days", KPI_SCHEMA, True, marts.exec_kpis),
            ("category_days", CATEGORY_SCHEMA, True, marts.sales_by_category),
            ("total_days", TOTAL_SCHEMA, False, day_totals)):
        state = _day_state(job, name, schema, of_fact)
        state.refresh(derive)
        made.append(state.read())
    return tuple(made)


def build_models(job: Job, window: Window | None) -> tuple[int, dict[str, DataFrame]]:
    """Rebuild what the window touches, or everything without one; return checks passed."""
    params = job.params
    since = reprocess_from(job, window)
    stored, attributes = build_dimensions(job, window)
    passed, fact = build_sales(job, since, attributes, stored)
    index = order_days(job)
    index.update(stored["stg_orders"].select(
        "order_id", "order_date", F.col("ingest_date").cast("string").alias("_ingest_date"),
        F.col("loaded_at").cast("string").alias("_loaded_at")))
    left = index.left()
    rebuild_days(job, left, attributes, exact=left)
    index.rebuilt(left)

    product_history(job).apply(stored["stg_products"], job.clock())

    dim = store(conform(marts.dim_product(attributes), "dim_product"), job.mart("dim_product"))
    kpi_days, category_days, sold = refresh_day_marts(job)
    kpis = store(conform(kpi_days, "mart_exec_kpis"), job.mart("mart_exec_kpis"))
    by_category = store(category_days, job.mart("mart_sales_by_category"))
    check_days(kpis, sold, {"mart_sales_by_category": by_category},
               exact=since is None or job.fact_mode == "window")
    ledger = ledger_state(job)
    ledger.refresh()
    health = store(conform(ledger.health(attributes), "mart_inventory_health"),
                   job.mart("mart_inventory_health"))

    models = {
        "dim_product": dim,
        "fct_daily_sales": fact,
        "mart_exec_kpis": kpis,
        "mart_sales_by_category": by_category,
        "mart_inventory_health": health,
    }
    whole = [c for c in mart_checks() if c.model in models and c.model != "fct_daily_sales"]
    of_ledger = [c for c in mart_checks() if c.model == "int_inventory_position"]
    products = [c for c in mart_checks() if c.kind == "references"]
    orphans = [(c, ledger.orphans(dim, c.parent[1]).first()[0]) for c in products]
    results = checks.run_checks("model", models, whole, params.warn_only).unionByName(
        refresh_fact_checks(job)).unionByName(
        checks.as_results(job.spark, "model", orphans, params.warn_only)).unionByName(
        ledger.checks(of_ledger, attributes, params.warn_only))
    passed += checks.raise_on_failure(results)[0]
    return passed, models


def run(job: Job, mode: str = "incremental", start: dt.date | None = None,
        end: dt.date | None = None,
        publisher: Callable[[dict[str, DataFrame]], None] | None = None) -> Outcome:
    """One run. ``publisher`` gets the marts to serve, the run status separately and last.

    A run claims the warehouse; one that starts while another is at work raises ``ConcurrentWrite``
    and changes nothing.
    """
    prepare(job.spark)
    started = job.clock()
    record = audit.RunRecord(uuid.uuid4().hex[:12], started, started, mode, None, None, 0, 0, 0,
                             "FAIL")
    with manifest.writing(job.spark, f"{job.root}/meta/run", f"run {record.run_id}", started):
        return _run(job, record, start, end, publisher)


def _run(job: Job, record: audit.RunRecord, start: dt.date | None, end: dt.date | None,
         publisher: Callable[[dict[str, DataFrame]], None] | None) -> Outcome:
    spark, started = job.spark, record.run_started_at
    try:
        sources = files.read_sources(spark, job.source_dir, job.source_files, job.multi_line)
        check_contracts(job, sources, start or started.date(), record.run_id)
        first_day, last_day, unreadable = files.event_profile(sources["orders"]).first()
        bounds = spark.createDataFrame([(first_day, last_day)], "first_day date, last_day date")
        window = plan(job, bounds, start, end)
        if window is None:
            _record(job, with_fields(record, status="NOOP"))
            return Outcome("NOOP")
        record = with_fields(record, window_start=window.start, window_end=window.end)
        if unreadable:
            set_aside_unreadable(job, sources["orders"], window.start, record.run_id)
        rows = land_window(job, sources, window)
        record = with_fields(record, rows_extracted=rows)
        gate_raw(job)
        passed, _ = build_models(job, window)
        served = publish.read_marts(spark, job.root, publish.PUBLISHED[:-1], complete=True)
        if publisher is not None:
            publisher(served)
        record = with_fields(record, status="PASS", run_finished_at=job.clock(),
                             tests_passed=passed + len(status_checks()))
        status = _status(job, record)
        checks.raise_on_failure(checks.run_checks(
            "model", {"mart_pipeline_status": status}, status_checks()))
    except Exception as error:
        failed = with_fields(record, status="FAIL", run_finished_at=job.clock(),
                             tests_passed=getattr(error, "passed", 0),
                             tests_failed=getattr(error, "failed", 0))
        audit.append_run(spark, job.root, failed)
        raise
    audit.append_run(spark, job.root, record)
    tile = store(status, job.mart("mart_pipeline_status"))
    if publisher is not None:
        publisher({"mart_pipeline_status": tile})
    log.info("run %s passed: %d rows, %d checks", record.run_id, rows, record.tests_passed)
    return Outcome("PASS", window, rows, record.tests_passed, 0)


def _record(job: Job, record: audit.RunRecord) -> None:
    audit.append_run(job.spark, job.root, with_fields(record, run_finished_at=job.clock()))


def _status(job: Job, record: audit.RunRecord) -> DataFrame:
    """The status row as it will be once ``record`` is in the history."""
    runs = job.spark.createDataFrame([audit.as_row(record)], audit.AUDIT_SCHEMA)
    fact = lake.read_table(job.spark, job.mart("fct_daily_sales"), FACT_SCHEMA)
    return marts.run_status(runs, fact, job.clock())


def backfill(job: Job, start: dt.date, end: dt.date,
             publisher: Callable[[dict[str, DataFrame]], None] | None = None) -> Outcome:
    """Run an explicit range of days. It leaves the watermark where it is."""
    return run(job, "backfill", start, end, publisher)


def full_refresh(job: Job) -> int:
    """Rebuild every model from the whole lake; return the checks passed."""
    prepare(job.spark)
    return build_models(job, None)[0]


def status(job: Job) -> tuple[DataFrame, DataFrame]:
    """The watermark and the last five runs."""
    runs = audit.read_audit(job.spark, job.root)
    return audit.watermark(runs), audit.recent_runs(runs)
