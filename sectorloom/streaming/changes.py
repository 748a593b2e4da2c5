"""Means that follow a feed of inserts, updates and deletes.

A change has the row before and the row after it; an insert has no row before, a delete none after. The row before
counts with the sign -1 and the row after with +1, so sums and counts can shrink, a row can move from one group to
another, and a group without rows goes. The state of a stream is one row per group, whatever the number of changes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGN = "__sign"
# Sums are decimals, so that what is taken back cancels exactly. Values count with so many digits after the point.
SCALE = 9


def signed_rows(changes: DataFrame, before: str = "before", after: str = "after") -> DataFrame:
    """The rows of ``changes`` (before struct, after struct of the same fields) with their sign, in one pass."""
    fields = changes.schema[after].dataType.names

    def row(name: str, sign: int) -> Column:
        values = [F.col(f"{name}.`{field}`").alias(field) for field in fields]
        return F.when(F.col(name).isNotNull(), F.struct(*values, F.lit(sign).alias(SIGN)))

    both = F.array_compact(F.array(row(before, -1), row(after, 1)))
    return changes.select(F.inline(both))


def mean_of_changes(
    signed: DataFrame, keys: Mapping[str, Column], value: str, name: str, scale: int = SCALE
) -> DataFrame:
    """The mean of ``value`` per group of ``keys`` over the rows that are there after all changes.

    Rows without a value count as rows of their group but not in the mean. Groups without rows are left out.
    A feed that takes back what it has not given shows as a group with fewer than no rows, which raises.
    """
    exact = F.col(value).cast(f"decimal({28},{scale})")
    grouped = signed.groupBy(*[key.alias(k) for k, key in keys.items()]).agg(
        F.sum(exact * F.col(SIGN)).alias("__total"),
        F.sum(F.when(F.col(value).isNotNull(), F.col(SIGN))).alias("__known"),
        F.sum(SIGN).alias("__rows"),
    )
    message = F.concat(F.lit("rows taken back that were not there: "), (-F.col("__rows")).cast("string"))
    rows = F.when(F.col("__rows") < 0, F.raise_error(message).cast("bigint")).otherwise(F.col("__rows"))
    mean = F.col("__total").cast("double") / F.nullif(F.col("__known"), F.lit(0))
    return grouped.where(rows != 0).select(*keys, mean.alias(name))
