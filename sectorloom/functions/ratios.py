"""Safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in double; NULL when either is NULL or the whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def capped_ratio(part: Column, whole: Column) -> Column:
    """As :func:`ratio`, at most 1. ``least`` would turn a NULL ratio into 1."""
    value = ratio(part, whole)
    return F.when(value > 1, F.lit(1.0)).otherwise(value)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(ratio(F.lit(100.0) * part, whole), digits)
