"""Declared column names, types and not-null rules of finished models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.upsert import SchemaChange

# model -> ((column, type, nullable), ...)
MART_SCHEMAS = {
    "dim_product": (
        ("product_id", "string", False),
        ("category_pt", "string", True),
        ("category_en", "string", True),
        ("cost_ratio", "double", True),
    ),
    "fct_daily_sales": (
        ("order_date", "date", False),
        ("product_id", "string", False),
        ("category_pt", "string", True),
        ("category_en", "string", True),
        ("units", "bigint", True),
        ("revenue", "double", True),
        ("cogs", "double", True),
        ("gross_margin", "double", True),
        ("margin_pct", "double", True),
    ),
    "mart_exec_kpis": (
        ("order_date", "date", False),
        ("active_skus", "bigint", True),
        ("units", "bigint", True),
        ("revenue", "double", True),
        ("gross_margin", "double", True),
        ("margin_pct", "double", True),
    ),
    "mart_inventory_health": (
        ("product_id", "string", False),
        ("category_en", "string", True),
        ("as_of_date", "date", True),
        ("on_hand_units", "bigint", True),
        ("reorder_point", "bigint", True),
        ("days_of_supply", "double", True),
        ("sell_through_rate", "double", True),
        ("is_stockout", "boolean", True),
        ("is_stockout_risk", "boolean", True),
        ("is_overstock", "boolean", True),
        ("inventory_status", "string", True),
    ),
}


def conform(df: DataFrame, model: str) -> DataFrame:
    """``df`` in the declared shape of ``model``.

    Wrong column names or types raise now. A null in a column that must not hold one raises in
    the task that meets it, while the model is written; no extra pass looks for it.
    """
    declared = MART_SCHEMAS[model]
    want = {name: kind for name, kind, _ in declared}
    got = {f.name: f.dataType.simpleString() for f in df.schema}
    if got != want:
        wrong = sorted(n for n in want.keys() | got.keys() if want.get(n) != got.get(n))
        raise SchemaChange(f"{model} breaks its declared columns: {', '.join(wrong)}")

    def checked(name: str, kind: str, nullable: bool):
        column = F.col(name)
        if nullable:
            return column
        message = F.lit(f"{model}.{name} must not be null")
        return F.coalesce(column, F.raise_error(message).cast(kind)).alias(name)

    return df.select(*[checked(*column) for column in declared])
