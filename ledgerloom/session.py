"""Session defaults. On a cluster the submitted configuration wins; these fill the gaps."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # All times are naive UTC.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts must raise; the staging models rely on it.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: join strategy, partition coalescing, skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Settings the results depend on, so they are also put on a session made elsewhere.
REQUIRED = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def get_session(app_name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    for key in REQUIRED:
        if spark.conf.get(key, None) != DEFAULTS[key]:
            spark.conf.set(key, DEFAULTS[key])
    return spark
