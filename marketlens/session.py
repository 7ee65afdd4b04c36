"""Session defaults for market-evidence jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "marketlens", **conf: str) -> SparkSession:
    """A UTC session with adaptive execution and skew joins on; conf overrides or adds settings."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    builder = SparkSession.builder.appName(app)
    for k, v in (defaults | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
