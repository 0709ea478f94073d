"""Source CSV files, every column read as text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import parse_date

EVENT_TIME = "order_purchase_timestamp"

# Files up to this size are read by one task.
WHOLE_BYTES = 64 << 20
# A line that is one record: fields quoted, with the quotes in them doubled, or without quotes.
_FIELD = r'(?:"[^"\r]*+(?:""[^"\r]*+)*+"|[^",\r]*+)'
RECORD = rf"^{_FIELD}(?:,{_FIELD})*+\z"

# File name pattern of each source table below the source directory.
SOURCE_FILES = {
    "orders": "*orders_dataset.csv",
    "order_items": "*order_items_dataset.csv",
    "products": "*products_dataset.csv",
    "customers": "*customers_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}


def source_dir(root: str, sample: bool) -> str:
    """The demo extract and the full extract lie side by side under one root."""
    return f"{root}/{'sample' if sample else 'source'}"


def _reader(spark: SparkSession, header: bool, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", header).option("inferSchema", False)
        .option("enforceSchema", False).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line)
    )


def source_paths(spark: SparkSession, directory: str, table: str,
                 files: Mapping[str, str] = SOURCE_FILES) -> list[str]:
    """The files of a source table, in order; any store Spark can read works."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{directory}/{files[table]}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    paths = sorted(status.getPath().toString() for status in found or [])
    if not paths:
        raise FileNotFoundError(f"no file for source table {table!r} at {directory}/{files[table]}")
    return paths


def headers_of(spark: SparkSession, paths: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """The column names in each file, as they stand there; one record is read of each."""
    headers = {}
    for path in paths:
        first = _reader(spark, header=False, multi_line=True).csv(path).first()
        headers[path] = tuple(name or "" for name in first or ())
    return headers


def read_headers(spark: SparkSession, directory: str, table: str,
                 files: Mapping[str, str] = SOURCE_FILES) -> dict[str, tuple[str, ...]]:
    """The column names in every file of a table."""
    return headers_of(spark, source_paths(spark, directory, table, files))


def _length(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).getLen()


def splittable(spark: SparkSession, path: str) -> bool:
    """Whether every line of a file is a record of its own, so that tasks can share the file.

    A quoted value that holds a line break leaves a line whose quotes do not pair up. Stray quotes, blank
    lines and carriage returns count as not splittable, as the two ways of reading may differ there.
    """
    odd = ~F.col("value").rlike(RECORD) | F.col("value").rlike(r"^\s+$")
    return spark.read.option("lineSep", "\n").text(path).filter(odd).isEmpty()


def read_files(spark: SparkSession, headers: Mapping[str, tuple[str, ...]],
               multi_line: bool = True) -> DataFrame:
    """Files of one table, given with their headers.

    No schema is given: Spark would bind it by position and hide a changed header from the
    contract check. Files whose headers differ are read apart and united by name. Only empty text
    is null; ``NA`` stays text. Quoted line breaks are part of a value, so a file that has any is read
    by one task. Files of more than ``WHOLE_BYTES`` are looked through first, and split if they have
    none; where no value has any, ``multi_line=False`` saves that.
    """
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for path, header in headers.items():
        whole = multi_line and not (_length(spark, path) > WHOLE_BYTES and splittable(spark, path))
        groups.setdefault((header, whole), []).append(path)
    parts = [_reader(spark, header=True, multi_line=whole).csv(paths)
             for (_, whole), paths in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_source(spark: SparkSession, directory: str, table: str,
                files: Mapping[str, str] = SOURCE_FILES, multi_line: bool = True) -> DataFrame:
    """One source table with the column names of its own headers; see ``read_files``."""
    return read_files(spark, read_headers(spark, directory, table, files), multi_line)


def read_sources(spark: SparkSession, directory: str, files: Mapping[str, str] = SOURCE_FILES,
                 multi_line: bool = True) -> dict[str, DataFrame]:
    return {table: read_source(spark, directory, table, files, multi_line) for table in files}


def event_date() -> Column:
    return parse_date(F.col(EVENT_TIME))


def event_bounds(orders: DataFrame) -> DataFrame:
    """First and last business day of the orders, one row; unreadable times are ignored."""
    day = event_date()
    return orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def event_profile(orders: DataFrame) -> DataFrame:
    """``event_bounds`` with the number of orders whose time is unreadable, in one scan."""
    day = event_date()
    return orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"),
                      F.count_if(day.isNull()).alias("unreadable"))
