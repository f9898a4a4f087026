"""A session with the settings the jobs in this package count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles a method of more than 8000 bytes; wide projections run faster in parts.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def session(app: str = "martloom", master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session; `extra` takes settings with `_` in place of `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()
