"""Session defaults for local work; a cluster's own settings win where they are given."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "groovemill", **conf: str) -> SparkSession:
    """A session with UTC, ANSI arithmetic and adaptive execution."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    builder = SparkSession.builder.appName(app)
    for k, v in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
