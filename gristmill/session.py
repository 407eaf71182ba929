"""A session with the settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "gristmill", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for k, v in {**defaults, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
