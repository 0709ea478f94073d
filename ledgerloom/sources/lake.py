"""Raw lake: Parquet partitioned by ingest day, plus a quarantine area beside it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.contracts import CONTRACTS

DRIFT_SCHEMA = "table_name string, business_day date, problem string, found_at timestamp_ntz"


def raw_path(root: str, table: str) -> str:
    return f"{root}/raw/{table}"


def quarantine_path(root: str, table: str) -> str:
    return f"{root}/quarantine/{table}"


def raw_schema(table: str) -> T.StructType:
    """All contract columns as text, the audit columns and the partition column.

    Reading with this schema unions partitions by name: a column a partition lacks is null.
    """
    names = (*CONTRACTS[table].columns, "_ingest_date", "_loaded_at")
    fields = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType([*fields, T.StructField("ingest_date", T.DateType())])


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table, or an empty frame of the same schema where none was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, root: str, table: str,
             since: dt.date | None = None) -> DataFrame:
    """A raw table; ``since`` prunes the ingest partitions before any file is opened."""
    raw = read_table(spark, raw_path(root, table), raw_schema(table))
    return raw if since is None else raw.filter(F.col("ingest_date") >= F.lit(since))


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """Any partitioned Parquet directory, union of the columns its files have."""
    return spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)


def stamp(df: DataFrame, loaded_at: str) -> DataFrame:
    """Audit columns of landed rows. ``loaded_at`` is UTC text to the second."""
    return (
        df.withColumn("_ingest_date", F.col("ingest_date").cast("string"))
        .withColumn("_loaded_at", F.lit(loaded_at))
    )


def land(df: DataFrame, path: str, loaded_at: str) -> None:
    """Replace the ingest partitions present in ``df``; leave the others alone.

    The rebalance lets AQE cut a huge day into several files and merge small ones.
    """
    (
        stamp(df, loaded_at).hint("rebalance", "ingest_date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date").parquet(path)
    )


def quarantine(df: DataFrame, root: str, table: str, day: dt.date, problems: Iterable[object],
               found_at: dt.datetime, run_id: str) -> None:
    """Keep an offending snapshot and a note of what was wrong with it.

    The snapshot is stored as it came, so only its own file decides the columns, and apart from
    those of other runs on the same day.
    """
    spark = df.sparkSession
    df.write.mode("append").parquet(
        f"{quarantine_path(root, table)}/ingest_date={day.isoformat()}/run_id={run_id}")
    notes = [(table, day, str(problem), found_at) for problem in problems]
    spark.createDataFrame(notes, DRIFT_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{root}/quarantine/drift_log")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
