"""A session with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.mapKeyDedupPolicy": "LAST_WIN"}


def session(name: str, **more: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    for k, v in {**SETTINGS, **more}.items():
        b = b.config(k, v)
    return b.getOrCreate()
