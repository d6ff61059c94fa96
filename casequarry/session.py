"""Session settings that the engine's plans assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime settings; none depends on the data's size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "casequarry", **settings: str) -> SparkSession:
    """The active session, or one with the engine's settings; keywords use __ for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
