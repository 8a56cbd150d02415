"""Session factory with the settings the engine is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "weft", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and skew handling on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
