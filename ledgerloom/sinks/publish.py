"""Serving copies of the marts: CSV files or a full refresh of database tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# --- Fixed values: the relations the dashboard reads ---------------------------------------
PUBLISHED = (
    "mart_exec_kpis",
    "mart_sales_by_category",
    "mart_inventory_health",
    "fct_daily_sales",
    "dim_product",
    "mart_pipeline_status",
)
# --- End of fixed values -------------------------------------------------------------------


def serving_projection(mart: DataFrame, upper: bool = False) -> DataFrame:
    """The mart as the serving store holds it: flags as 0 and 1, upper-case names on request."""
    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.BooleanType):
            value = value.cast("int")
        return value.alias(field.name.upper() if upper else field.name)

    return mart.select(*[column(f) for f in mart.schema])


def _built(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_marts(spark: SparkSession, root: str, names: tuple[str, ...] = PUBLISHED,
               complete: bool = False) -> dict[str, DataFrame]:
    """The marts built so far, or, if ``complete``, all of them; unreadable ones raise."""
    paths = {name: f"{root}/marts/{name}" for name in names}
    absent = [] if complete else [name for name in names if not _built(spark, paths[name])]
    if absent:
        log.warning("not built yet: %s", ", ".join(absent))
    return {name: spark.read.parquet(paths[name]) for name in names if name not in absent}


def export_csv(marts: Mapping[str, DataFrame], directory: str) -> None:
    """One directory of CSV files with a header per mart, written in parallel."""
    for name, mart in marts.items():
        mart.write.mode("overwrite").option("header", True).csv(f"{directory}/{name.upper()}")


def publish_jdbc(marts: Mapping[str, DataFrame], url: str, properties: Mapping[str, str],
                 connections: int = 8, batch_rows: int = 10_000) -> None:
    """Empty and refill each database table, over a bounded number of connections."""
    for name, mart in marts.items():
        (
            serving_projection(mart, upper=True).coalesce(connections)
            .write.mode("overwrite").option("truncate", True)
            .option("batchsize", batch_rows)
            .jdbc(url, name.upper(), properties=dict(properties))
        )
