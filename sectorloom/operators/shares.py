"""Counts per category with their share of the total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import percent


def share_of_total(df: DataFrame, category: str) -> DataFrame:
    """``category``, ``count`` and ``percentage`` (two digits), largest first.

    The total is a scalar subquery over the grouped rows, so no window has to gather the categories in
    one task.
    """
    counts = df.groupBy(category).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.withColumn("percentage", percent(F.col("count"), total, 2)).orderBy(
        F.desc("count"), F.col(category).asc_nulls_last()
    )
