"""Small helpers the operators share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerloom

# Words are runs of characters outside this class.
WORD_GAP = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(ledgerloom.__file__))
    # The driver serves the file for as long as the application runs.
    folder = tempfile.mkdtemp(prefix="ledgerloom-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    copy = shutil.copytree(package, f"{folder}/root/{os.path.basename(package)}",
                           ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(
        f"{folder}/ledgerloom_files", "zip", os.path.dirname(copy)))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8_slices(batches, rows: int):
    """Arrow batches cut to at most ``rows`` rows, so that a worker's working set stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
