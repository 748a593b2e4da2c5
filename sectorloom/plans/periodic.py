"""Mean metrics per calendar period, for batch and streaming inputs alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import period_start
from ..streaming.changes import mean_of_changes


def functioning_by_year_region(water_data: DataFrame) -> DataFrame:
    return water_data.groupBy(
        period_start(F.col("date_recorded"), "year").alias("year"), "region"
    ).agg(F.avg("functioning_percentage").alias("percentage"))


def functioning_of_changes(signed: DataFrame) -> DataFrame:
    """:func:`functioning_by_year_region` of the rows that a feed of changes leaves (``changes.signed_rows``)."""
    keys = {"year": period_start(F.col("date_recorded"), "year"), "region": F.col("region")}
    return mean_of_changes(signed, keys, "functioning_percentage", "percentage")


def monthly_metrics(source_data: DataFrame) -> DataFrame:
    return source_data.groupBy(
        period_start(F.col("recorded_date"), "month").alias("month")
    ).agg(F.avg("metric").alias("metric_value"))
