"""Spark session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "shoalframe", **conf: str) -> SparkSession:
    """The active session, or a new one: UTC, adaptive execution, the later of two equal map keys wins."""
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
