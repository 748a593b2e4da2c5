"""Infrastructure coverage per district."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import year_stamp
from .lookups import district_labels


def coverage_yearly(reports: DataFrame, admin: DataFrame) -> DataFrame:
    """Mean coverage per district and year."""
    means = reports.groupBy(
        F.col("district").alias("district_code"), F.year("report_datetime").alias("year")
    ).agg(F.avg("infracoverage").alias("avg_infracoverage"))
    return district_labels(means, admin).withColumn("year_timestamp", year_stamp(F.col("year")))


def coverage_latest(reports: DataFrame, admin: DataFrame) -> DataFrame:
    """Mean of the positive values on the latest date; the date is taken over all rows.

    The date test is a range on the raw column, so that file statistics prune the second scan.
    """
    day = reports.agg(F.max("report_datetime").cast("date").alias("day")).scalar()
    stamp = F.col("report_datetime")
    on_day = (stamp >= day.cast("timestamp_ntz")) & (
        stamp < F.date_add(day, 1).cast("timestamp_ntz")
    )
    means = (
        reports.where(on_day & (F.col("infracoverage") > 0))
        .groupBy(F.col("district").alias("district_code"))
        .agg(F.avg("infracoverage").alias("avg_infracoverage"))
    )
    return district_labels(means, admin)
