"""Store an intermediate result that several later steps read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    Only a local session without one gets a temporary folder; on a cluster that would be a
    folder no other machine sees, so a missing setting is an error there.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder all executors can reach")
    if context.applicationId not in _local_dirs:
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_dirs[context.applicationId] = folder
    return _local_dirs[context.applicationId]


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` read back from a Parquet copy of itself, written with these ``options``.

    Readers scan only the columns they need, a lost executor costs a re-read instead of the
    whole lineage, and steps that share the frame do not compute it again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
