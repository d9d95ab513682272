"""Session settings that the plans were tuned with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; `extra` uses ``__`` for dots and wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
