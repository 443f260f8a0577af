"""Session settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName("quillon").config(map={**SETTINGS, **more})
    return (builder.master(master) if master else builder).getOrCreate()
