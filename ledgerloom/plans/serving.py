"""Dashboard queries over the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import money, round_half_away, safe_ratio


def kpi_headline(kpis: DataFrame) -> DataFrame:
    revenue, margin = F.sum(money(F.col("revenue"))), F.sum(money(F.col("gross_margin")))
    return kpis.agg(
        revenue.cast("double").alias("total_revenue"),
        margin.cast("double").alias("total_gross_margin"),
        round_half_away(safe_ratio(margin, revenue), 4).alias("margin_pct"),
        F.sum("units").alias("total_units"),
        F.sum("active_skus").alias("sku_day_count"),
    )


def revenue_margin_trend(kpis: DataFrame, start: dt.date | None = None,
                         end: dt.date | None = None) -> DataFrame:
    if start is not None:
        kpis = kpis.filter(F.col("order_date") >= F.lit(start))
    if end is not None:
        kpis = kpis.filter(F.col("order_date") <= F.lit(end))
    return kpis.select(
        "order_date", "revenue", "gross_margin",
        (F.col("margin_pct") * F.lit(100.0)).alias("margin_pct"),
    ).orderBy("order_date")


def margin_by_category(by_category: DataFrame) -> DataFrame:
    revenue, margin = F.sum(money(F.col("revenue"))), F.sum(money(F.col("gross_margin")))
    return by_category.groupBy("category_en").agg(
        revenue.cast("double").alias("revenue"),
        margin.cast("double").alias("gross_margin"),
        round_half_away(safe_ratio(margin, revenue) * F.lit(100.0), 1).alias("margin_pct"),
    ).orderBy(F.col("gross_margin").desc_nulls_last(), F.col("category_en").asc_nulls_last())


def _percent(name: str):
    return round_half_away(F.col(name) * F.lit(100.0), 1)


def stockout_risk(health: DataFrame) -> DataFrame:
    return (
        health.filter(F.col("inventory_status").isin("STOCKOUT", "REORDER_NOW"))
        .select("product_id", "category_en", "inventory_status", "on_hand_units",
                "reorder_point", "days_of_supply",
                _percent("sell_through_rate").alias("sell_through_pct"), "as_of_date")
        .orderBy(F.col("days_of_supply").asc_nulls_last(), F.col("on_hand_units").asc_nulls_last(),
                 "product_id")
    )


def sell_through(health: DataFrame) -> DataFrame:
    return health.orderBy(F.col("sell_through_rate").desc_nulls_last(), "product_id").select(
        "product_id", "category_en",
        _percent("sell_through_rate").alias("sell_through_pct"),
        "on_hand_units", "days_of_supply", "inventory_status",
        F.when(F.col("is_overstock"), "YES").otherwise("NO").alias("overstock_markdown_risk"),
    )


def inventory_status_breakdown(health: DataFrame) -> DataFrame:
    return health.groupBy("inventory_status").agg(F.count(F.lit(1)).alias("skus"))


def status_tile(status: DataFrame) -> DataFrame:
    return status.select(
        "pipeline_health",
        F.date_format("last_refreshed_at", "yyyy-MM-dd HH:mm").alias("last_refreshed"),
        "hours_since_refresh", "tests_passed", "tests_failed",
        F.date_format("data_through_date", "yyyy-MM-dd").alias("data_through"),
        "last_rows_extracted",
    )
