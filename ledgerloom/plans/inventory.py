"""Inventory ledger: opening stock plus scheduled restocks minus cumulative sales.

The ledger is dense, one row per product and day, but only the sparse sales rows are shuffled
and ordered. Each of them is then stretched over the days up to the product's next sale, so
there is no product-by-day cross join, no join back to the sales, and no shuffle of the grid.
Stock stands still between sales and restocks, so it is worked out per run of such days.

The span of days is a scalar subquery over the same daily sales, so callers pass a stored or
materialized table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import round_half_away, safe_ratio, spread_bucket
from ledgerloom.operators.dedup import latest_wins
from ledgerloom.params import Params
from ledgerloom.plans.sales import UNKNOWN

# --- Fixed values: the supply factor runs from 0.2 up to 2.0 in steps of 1/1000 -----------
FACTOR_BASE = 0.2
FACTOR_SPAN = 1.8
FACTOR_STEPS = 1000
MIN_DAILY_DEMAND = 0.1
# --- End of fixed values ------------------------------------------------------------------

# The ledger's columns that stand still between sales and restocks.
_STOCK = ("expected_daily_demand", "opening_stock", "restock_qty", "cum_replenishment", "on_hand",
          "on_hand_units", "reorder_point", "total_supply", "days_of_supply", "is_stockout_risk",
          "is_stockout", "is_overstock", "sell_through_rate")


def _span(daily: DataFrame) -> Column:
    """First and last day with sales, as a scalar struct."""
    return daily.agg(F.struct(
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"),
    ).alias("span")).scalar()


def date_spine(daily: DataFrame) -> DataFrame:
    """Every day from the first to the last sale."""
    first, last = F.min("order_date").alias("first"), F.max("order_date").alias("last")
    return daily.agg(first, last).select(F.explode(F.sequence("first", "last")).alias("inv_date"))


def _with_category(rows: DataFrame, attributes: DataFrame | None) -> DataFrame:
    """Rows with the categories of ``attributes``, or with their own where that is None.

    A product has at most one row per day here, so this join has no large key.
    """
    if attributes is None:
        return rows
    current = attributes.select("product_id", "category_pt", "category_en")
    joined = rows.drop("category_pt", "category_en").join(current, "product_id", "left")
    return joined.fillna(UNKNOWN, ["category_pt", "category_en"])


def _stretches(daily: DataFrame, attributes: DataFrame | None, span: Column,
               parts: int | None = None) -> DataFrame:
    """Each sale day with the days up to the product's next one, ``_begin`` to ``_until``.

    The first of a product begins with the span. ``_cum`` and ``_total`` are running and total units. A
    product sold under two categories on one day has two rows there; they are one sale day, under the
    greater of the categories.
    """
    sold = _per_day(daily, parts).selectExpr(
        "*",
        "sum(units_sold) OVER (PARTITION BY product_id ORDER BY order_date "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _cum",
        "sum(units_sold) OVER (PARTITION BY product_id) AS _total",
        "lag(order_date) OVER (PARTITION BY product_id ORDER BY order_date) AS _previous",
        "lead(order_date) OVER (PARTITION BY product_id ORDER BY order_date) AS _next",
    )
    first_day, last_day = span.getField("first_day"), span.getField("last_day")
    begin = F.when(F.col("_previous").isNull(), first_day).otherwise(F.col("order_date"))
    return _with_category(sold, attributes).withColumns({
        "_begin": begin, "_until": F.coalesce(F.date_sub("_next", 1), last_day)})


def _days(rows: DataFrame, begin: str, until: str) -> DataFrame:
    """Every row on each day from ``begin`` to ``until``, with units and revenue on its sale day only."""
    days = F.when(F.col(begin) <= F.col(until), F.sequence(begin, until))
    is_sale_day = F.col("inv_date") == F.col("order_date")
    return rows.withColumn("inv_date", F.explode(days)).withColumns({
        c: F.when(is_sale_day, F.col(c)).otherwise(F.lit(0).cast(rows.schema[c].dataType))
        for c in ("units_sold", "revenue")})


def _standing(stretches: DataFrame, span: Column, params: Params) -> DataFrame:
    """The stretches cut into runs of days, ``_from`` to ``_to``, on which the stock stands still.

    Stock changes with a sale and at the start of a restock interval, so the ledger of a run's first day
    is that of all its days.
    """
    first_day, last_day = span.getField("first_day"), span.getField("last_day")
    step = F.lit(params.restock_interval_days)
    begin, until, sale = F.col("_begin"), F.col("_until"), F.col("order_date")

    def run(start: Column, end: Column, units: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), units.alias("units"))

    whole = F.array(run(begin, until, F.col("_cum")))
    cut = F.array(run(begin, F.least(F.date_sub(sale, 1), until), F.lit(0).cast("bigint")),
                  run(sale, until, F.col("_cum")))
    runs = stretches.withColumn("_run", F.explode(F.when(begin < sale, cut).otherwise(whole))).filter(
        "_run.start <= _run.end")

    def interval(day: Column) -> Column:
        return F.floor(F.datediff(day, first_day) / step).cast("int")

    def start_of(number: Column) -> Column:
        return F.date_add(first_day, number * step)

    start, end, number = F.col("_run.start"), F.col("_run.end"), F.col("_interval")
    return runs.withColumn(
        "_interval", F.explode(F.sequence(interval(start), interval(end)))).select(
        "product_id", "category_pt", "category_en", "order_date", "units_sold", "revenue",
        F.greatest(start, start_of(number)).alias("_from"),
        F.least(end, F.date_sub(start_of(number + 1), 1)).alias("_to"),
        F.col("_run.units").alias("cum_units"),
        F.datediff(F.greatest(start, start_of(number)), first_day).alias("days_elapsed"),
        demand(F.col("_total"), F.datediff(last_day, first_day) + 1),
    )


def _per_day(daily: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per product and day; the product's rows are already together for the windows."""
    dealt = daily.repartition("product_id") if parts is None else daily.repartition(
        parts, "product_id")
    sums = [F.sum("units_sold").alias("units_sold"),
            F.sum("revenue").cast(daily.schema["revenue"].dataType).alias("revenue")]
    if "category_pt" not in daily.columns:
        return dealt.groupBy("product_id", "order_date").agg(*sums)
    category = F.max(F.struct("category_pt", "category_en")).alias("_category")
    return dealt.groupBy("product_id", "order_date").agg(
        *sums, category).select("product_id", "order_date", "units_sold", "revenue", "_category.*")


def demand(total_units: Column, days: Column) -> Column:
    """Mean units a day, as ``expected_daily_demand``."""
    mean = total_units.cast("double") / days.cast("double")
    return F.greatest(mean, F.lit(MIN_DAILY_DEMAND)).alias("expected_daily_demand")


def stock_factor(product_id: Column) -> Column:
    step = spread_bucket(product_id, FACTOR_STEPS).cast("double") / F.lit(float(FACTOR_STEPS))
    return F.lit(FACTOR_BASE) + F.lit(FACTOR_SPAN) * step


def inventory_grid(daily: DataFrame) -> DataFrame:
    return _days(_stretches(daily, None, _span(daily)), "_begin", "_until").select(
        "product_id", "category_pt", "category_en", "inv_date", "units_sold", "revenue")


def ledger(state: DataFrame, params: Params) -> DataFrame:
    """Stock columns of rows with cum_units, days_elapsed and expected_daily_demand.

    Later columns refer to earlier ones of the same select.
    """
    per_day = F.col("expected_daily_demand")

    def cover(days: int, floor: int) -> Column:
        units = F.ceil(per_day * F.lit(float(days)) * F.col("_factor"))
        return F.greatest(F.lit(floor), units).cast("bigint")

    restocks = F.floor(F.col("days_elapsed") / F.lit(params.restock_interval_days))
    return state.select(
        "*",
        stock_factor(F.col("product_id")).alias("_factor"),
        cover(params.opening_stock_days, params.min_opening_stock).alias("opening_stock"),
        cover(params.restock_cover_days, 1).alias("restock_qty"),
        (restocks.cast("bigint") * F.col("restock_qty")).alias("cum_replenishment"),
        (F.col("opening_stock") + F.col("cum_replenishment")).alias("total_supply"),
        (F.col("total_supply") - F.col("cum_units")).alias("on_hand"),
        F.greatest(F.col("on_hand"), F.lit(0)).alias("on_hand_units"),
        F.ceil(per_day * F.lit(float(params.reorder_point_days))).cast("bigint")
        .alias("reorder_point"),
        round_half_away(F.col("on_hand_units").cast("double") / per_day, 1)
        .alias("days_of_supply"),
        (F.col("on_hand") <= F.col("reorder_point")).alias("is_stockout_risk"),
        (F.col("on_hand") <= 0).alias("is_stockout"),
        (F.col("days_of_supply") > params.overstock_days).alias("is_overstock"),
        F.when(F.col("total_supply") > 0,
               round_half_away(safe_ratio(F.col("cum_units"), F.col("total_supply")), 4))
        .otherwise(F.lit(0.0)).alias("sell_through_rate"),
    )


def inventory_position(daily: DataFrame, params: Params,
                       attributes: DataFrame | None = None,
                       span: Column | None = None, parts: int | None = None) -> DataFrame:
    """The ledger, one row per product and day; ``span`` where ``daily`` is a part of the sales.

    Stock columns are worked out once per run of days on which they stand still. ``parts`` deals the
    products to so many tasks, where the planner would go by the size of the sales alone.
    """
    span = _span(daily) if span is None else span
    standing = _standing(_stretches(daily, attributes, span, parts), span, params)
    positions = ledger(standing, params).select(
        "product_id", "category_pt", "category_en", "order_date", "_from", "_to",
        F.col("units_sold").cast("bigint").alias("units_sold"),
        F.col("revenue").cast("double").alias("revenue"),
        F.col("cum_units").cast("bigint").alias("cum_units"), *_STOCK)
    return _days(positions, "_from", "_to").select(
        "product_id", "category_pt", "category_en", "inv_date", "units_sold", "revenue", "cum_units",
        *_STOCK)


def latest_position(daily: DataFrame, params: Params,
                    attributes: DataFrame | None = None) -> DataFrame:
    """The ledger's last day, without building the days before it.

    On the last day the running units are the product's total and the elapsed days are the
    whole span, so one aggregation per product is enough.
    """
    totals = [F.sum("units_sold").alias("cum_units")]
    if attributes is None:
        totals.append(F.max(F.struct("order_date", "category_pt", "category_en")).alias("_last"))
    totals = daily.groupBy("product_id").agg(*totals)
    if attributes is None:
        totals = totals.select("product_id", "cum_units", "_last.category_pt", "_last.category_en")
    span = _span(daily)
    return position_of_totals(totals, span.getField("first_day"), span.getField("last_day"), params,
                              attributes)


def position_of_totals(totals: DataFrame, first_day: Column, last_day: Column, params: Params,
                       attributes: DataFrame | None = None) -> DataFrame:
    """The last day's ledger from the units of each product, ``cum_units``."""
    elapsed = F.datediff(last_day, first_day)
    state = _with_category(totals, attributes).select(
        "product_id", "category_pt", "category_en", "cum_units",
        last_day.alias("inv_date"),
        elapsed.alias("days_elapsed"),
        demand(F.col("cum_units"), elapsed + 1),
    )
    return ledger(state, params)


def health(positions: DataFrame) -> DataFrame:
    """Status of each product from its latest ledger row."""
    status = (
        F.when(F.col("is_stockout"), "STOCKOUT")
        .when(F.col("is_stockout_risk"), "REORDER_NOW")
        .when(F.col("is_overstock"), "OVERSTOCK")
        .otherwise("HEALTHY")
    )
    return positions.select(
        "product_id", "category_en", F.col("inv_date").alias("as_of_date"), "on_hand_units",
        "reorder_point", "days_of_supply", "sell_through_rate", "is_stockout",
        "is_stockout_risk", "is_overstock", status.alias("inventory_status"),
    )


def inventory_health(positions: DataFrame) -> DataFrame:
    """Health from a ledger of any extent: each product's newest row."""
    return health(latest_wins(positions, ["product_id"], [], recency=["inv_date"]))


def inventory_health_closed(daily: DataFrame, params: Params,
                            attributes: DataFrame | None = None) -> DataFrame:
    """Health straight from daily sales, for catalogues of any size."""
    return health(latest_position(daily, params, attributes))
