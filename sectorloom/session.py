"""Session settings the marts are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def builder(master: str | None = None) -> SparkSession.Builder:
    """A session builder. Off a laptop, sizes come from the cluster's own settings."""
    chosen = (
        SparkSession.builder.appName("sectorloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        chosen = (
            chosen.master(master)
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.driver.memory", "8g")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    return chosen
