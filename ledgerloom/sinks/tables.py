"""Parquet tables of the warehouse: whole rewrites and rewrites of single days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def store(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path``, which ``df`` must not read, and return it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop path and file system, so any store Spark can write to works."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Finished versions of a table, oldest first."""
    target, fs = hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(n for n in names if n.startswith("v")
                  and fs.exists(hadoop_path(spark, f"{path}/{n}/_SUCCESS")[0]))


def read_version(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The newest finished version of a table, or an empty frame before the first."""
    finished = _versions(spark, path)
    if not finished:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{finished[-1]}")


def write_version(df: DataFrame, path: str) -> DataFrame:
    """Write the next version of a table whose history cannot be rebuilt; ``df`` may read it.

    Readers see the old version until the new one is complete, so a run that dies on the way
    loses nothing. The version before the new one is kept, older ones are deleted.
    """
    spark = df.sparkSession
    finished = _versions(spark, path)
    number = int(finished[-1][1:]) + 1 if finished else 1
    written = store(df, f"{path}/v{number:010d}")
    for old in finished[:-1]:
        target, fs = hadoop_path(spark, f"{path}/{old}")
        fs.delete(target, True)
    return written


def write_days(df: DataFrame, path: str, day_column: str) -> None:
    """Replace the day partitions present in ``df`` and leave the others alone.

    The mode is set on this write, whatever the session default, and the job swaps partitions
    in only after all its tasks are done, so ``df`` may read the partitions it replaces. The
    rebalance lets AQE split a huge day over several files and merge small days.
    """
    (
        df.hint("rebalance", day_column).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(day_column).parquet(path)
    )


def day_files(spark: SparkSession, path: str, day_column: str,
              days: Iterable[dt.date]) -> dict[dt.date, frozenset[str]]:
    """The data files of those of the day partitions that exist. Every write names its files anew."""
    found = {}
    for day in days:
        partition, fs = hadoop_path(spark, f"{path}/{day_column}={day.isoformat()}")
        if fs.exists(partition):
            found[day] = frozenset(s.getPath().getName() for s in fs.listStatus(partition))
    return found


def drop_days(spark: SparkSession, path: str, day_column: str, days: Iterable[dt.date]) -> None:
    """Delete whole day partitions, which a dynamic overwrite without rows for them keeps."""
    for day in days:
        partition, fs = hadoop_path(spark, f"{path}/{day_column}={day.isoformat()}")
        fs.delete(partition, True)
    spark.catalog.refreshByPath(path)
