"""Dimension, fact and executive marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import hours_between, money, round_half_away, safe_ratio


def dim_product(attributes: DataFrame) -> DataFrame:
    return attributes.select("product_id", "category_pt", "category_en",
                             F.col("cost_ratio").cast("double").alias("cost_ratio"))


def _cents(name: str) -> Column:
    return money(F.round(F.col(name), 2)).cast("double").alias(name)


def fct_daily_sales(daily: DataFrame) -> DataFrame:
    """Sales fact, one row per day and product. A day without revenue has margin 0."""
    margin = safe_ratio(F.col("gross_margin"), F.col("revenue"))
    return daily.select(
        "order_date", "product_id", "category_pt", "category_en",
        F.col("units_sold").cast("bigint").alias("units"),
        _cents("revenue"), _cents("cogs"), _cents("gross_margin"),
        F.when(F.col("revenue") > 0, round_half_away(margin, 4)).otherwise(F.lit(0.0))
        .alias("margin_pct"),
    )


def _total(name: str) -> Column:
    return F.sum(money(F.col(name))).cast("double").alias(name)


def _margin(places: int = 4, factor: float | None = None) -> Column:
    """Margin over grouped rows; null without revenue."""
    share = safe_ratio(F.sum(money(F.col("gross_margin"))), F.sum(money(F.col("revenue"))))
    if factor is not None:
        share = share * F.lit(factor)
    return round_half_away(share, places).alias("margin_pct")


def exec_kpis(fact: DataFrame) -> DataFrame:
    """One line per day. The fact has one row per day and product, so counting rows is enough."""
    return fact.groupBy("order_date").agg(
        F.count("product_id").alias("active_skus"),
        F.sum("units").alias("units"),
        _total("revenue"), _total("gross_margin"), _margin(),
    )


def sales_by_category(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_date", "category_en").agg(
        F.sum("units").alias("units"),
        _total("revenue"), _total("cogs"), _total("gross_margin"), _margin(),
    )


def run_status(audit: DataFrame, fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row about the last passed run and the data, also before the first run."""
    order = F.struct("run_finished_at", "run_id")
    last = audit.filter(F.col("status") == "PASS").agg(
        F.max_by(F.struct("run_finished_at", "rows_extracted", "tests_passed", "tests_failed"),
                 order).alias("run"))
    data_through = fact.agg(F.max("order_date")).scalar()
    finished, failed = F.col("run.run_finished_at"), F.coalesce("run.tests_failed", F.lit(0))
    health = (
        F.when(finished.isNull(), "UNKNOWN").when(failed == 0, "PASSING").otherwise("FAILING")
    )
    return last.select(
        finished.alias("last_refreshed_at"),
        F.col("run.rows_extracted").alias("last_rows_extracted"),
        F.coalesce("run.tests_passed", F.lit(0)).alias("tests_passed"),
        failed.alias("tests_failed"),
        data_through.alias("data_through_date"),
        hours_between(finished, F.lit(as_of).cast("timestamp_ntz")).alias("hours_since_refresh"),
        health.alias("pipeline_health"),
    )


def source_freshness(raw: DataFrame, as_of: dt.datetime, warn_hours: int,
                     error_hours: int) -> DataFrame:
    """Age of the newest loaded row and whether that is acceptable."""
    newest = raw.agg(F.max(F.col("_loaded_at").try_cast("timestamp_ntz")).alias("newest_loaded_at"))
    age = hours_between(F.col("newest_loaded_at"), F.lit(as_of).cast("timestamp_ntz"))
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass")
    )
    return newest.withColumn("age_hours", age).withColumn("status", status)


def reconciliation(fact: DataFrame, daily: DataFrame) -> DataFrame:
    """Days on which the fact and the daily sales behind the ledger disagree."""
    published = fact.groupBy("order_date").agg(
        F.sum("units").alias("fact_units"), F.sum(money(F.col("revenue"))).alias("fact_revenue"))
    current = daily.groupBy("order_date").agg(
        F.sum("units_sold").alias("sales_units"), F.sum("revenue").alias("sales_revenue"))
    same = (
        F.col("fact_units").eqNullSafe(F.col("sales_units"))
        & F.col("fact_revenue").eqNullSafe(F.col("sales_revenue"))
    )
    return published.join(current, "order_date", "full").filter(~same).select(
        "order_date", "fact_units", "sales_units",
        F.col("fact_revenue").cast("double").alias("fact_revenue"),
        F.col("sales_revenue").cast("double").alias("sales_revenue"),
    )
