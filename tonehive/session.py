"""Sessions with the settings that the queries expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(name: str = "tonehive", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS, overridden by `settings`; the master is the environment's by default."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()
