"""The category cost ratios, a small table kept with the parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import ratio
from ledgerloom.params import Params


def cost_ratios(spark: SparkSession, params: Params) -> DataFrame:
    rows = [(name, value) for name, value in params.cost_ratios.items()]
    seed = spark.createDataFrame(rows, "product_category_name string, cost_ratio string")
    return seed.withColumn("cost_ratio", ratio(F.col("cost_ratio")))
