"""Run history: an append-only table from which the watermark follows."""

from __future__ import annotations

import datetime as dt
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.lake import read_table

AUDIT_SCHEMA = (
    "run_id string, run_started_at timestamp_ntz, run_finished_at timestamp_ntz, mode string, "
    "window_start date, window_end date, rows_extracted bigint, tests_passed int, "
    "tests_failed int, status string"
)


@dataclass(frozen=True)
class RunRecord:
    run_id: str
    run_started_at: dt.datetime
    run_finished_at: dt.datetime
    mode: str
    window_start: dt.date | None
    window_end: dt.date | None
    rows_extracted: int
    tests_passed: int
    tests_failed: int
    status: str


def audit_path(root: str) -> str:
    return f"{root}/meta/runs"


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, audit_path(root), AUDIT_SCHEMA)


def as_row(record: RunRecord) -> tuple:
    return astuple(record)


def append_run(spark: SparkSession, root: str, record: RunRecord) -> None:
    row = spark.createDataFrame([as_row(record)], AUDIT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(audit_path(root))


def watermark(audit: DataFrame) -> DataFrame:
    """One row: last business day loaded for good, when, and after how many runs.

    Only passed incremental runs count. A maximum never moves back, and a backfill of old days
    cannot jump over days the daily run has yet to load.
    """
    done = (F.col("status") == "PASS") & (F.col("mode") == "incremental")
    return audit.filter(done).agg(
        F.max("window_end").alias("last_loaded_date"),
        F.max("run_finished_at").alias("last_run_at"),
        F.count(F.lit(1)).alias("runs"),
    )


def recent_runs(audit: DataFrame, n: int = 5) -> DataFrame:
    return (
        audit.select("run_id", "window_start", "window_end", "rows_extracted", "tests_passed",
                     "tests_failed", "status", "run_finished_at")
        .orderBy(F.col("run_finished_at").desc_nulls_last(), F.col("run_id").desc())
        .limit(n)
    )
