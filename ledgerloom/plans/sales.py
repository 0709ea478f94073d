"""Order lines enriched with category, cost and margin, and their daily totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ratio
from ledgerloom.params import Params

UNKNOWN = "unknown"


def product_attributes(products: DataFrame, translations: DataFrame, ratios: DataFrame,
                       params: Params) -> DataFrame:
    """Category in both languages and cost ratio of every product.

    Few categories cover all products, but translations and ratios are one row per category, so
    the planner broadcasts what is small and AQE splits an overfull partition otherwise.
    """
    translated = products.select("product_id", "category_pt").join(
        translations, "category_pt", "left")
    priced = translated.join(
        ratios.withColumnRenamed("product_category_name", "category_pt"), "category_pt", "left")
    return priced.select(
        "product_id",
        F.coalesce("category_pt", F.lit(UNKNOWN)).alias("category_pt"),
        F.coalesce("category_en", "category_pt", F.lit(UNKNOWN)).alias("category_en"),
        F.coalesce("cost_ratio", ratio(F.lit(params.default_cost_ratio))).alias("cost_ratio"),
    )


def enriched_items(lines: DataFrame, headers: DataFrame, attributes: DataFrame,
                   params: Params) -> DataFrame:
    """One row per order line with a header; lines of unknown products are kept.

    The right sides have one row per key. A partition that a large order or product overfills is
    split at run time (AQE skew join), which costs nothing where there is none.
    """
    with_product = lines.join(headers, "order_id").join(attributes, "product_id", "left")
    cost_ratio = F.coalesce("cost_ratio", ratio(F.lit(params.default_cost_ratio)))
    price = F.col("item_price")
    return with_product.select(
        "order_id",
        "order_item_id",
        "product_id",
        "order_date",
        "order_status",
        F.col("order_status").isin(*params.valid_statuses).alias("is_valid_sale"),
        F.coalesce("category_pt", F.lit(UNKNOWN)).alias("category_pt"),
        F.coalesce("category_en", F.lit(UNKNOWN)).alias("category_en"),
        "units",
        price.alias("revenue"),
        F.round(price * cost_ratio, 2).alias("cogs"),
        F.round(price - price * cost_ratio, 2).alias("gross_margin"),
    )


def daily_product_sales(enriched: DataFrame) -> DataFrame:
    """Realised sales per day and product."""
    return (
        enriched.filter("is_valid_sale")
        .groupBy("order_date", "product_id", "category_pt", "category_en")
        .agg(
            F.sum("units").alias("units_sold"),
            F.sum("revenue").alias("revenue"),
            F.sum("cogs").alias("cogs"),
            F.sum("gross_margin").alias("gross_margin"),
        )
    )
