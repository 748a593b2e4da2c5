"""One row per key, lookups by key, and key checks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sizing import fits_in_broadcast, measure


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the stated order.

    Spark trims each key to one row before the shuffle (WindowGroupLimit), so a hot key costs one row per
    map task.
    """
    ranked = df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


@dataclass(frozen=True)
class Lookup:
    """Columns to take from ``table``; ``on`` is (column of the facts, column of the table).

    ``take`` maps new names to columns of the table.
    """

    table: DataFrame
    on: tuple[str, str]
    take: Mapping[str, str]

    @cached_property
    def one(self) -> DataFrame:
        return one_match(self.table, self.on[1], self.take)

    def is_small(self) -> bool:
        """Whether it is proven to fit in a broadcast, as it is or cut to one row per key."""
        return fits_in_broadcast(self.table, [self.on[1], *self.take.values()]) or fits_in_broadcast(self.one)


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: tuple[str, str],
    take: Mapping[str, str],
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """One lookup of :func:`lookup_joins`."""
    return lookup_joins(df, [Lookup(lookup, on, take)], spread_by)


def lookup_joins(df: DataFrame, lookups: Sequence[Lookup], spread_by: Sequence[str] = ()) -> DataFrame:
    """Attach columns of several lookups without ever changing the row count of ``df``.

    Taken columns replace those of the same name, so no lookup may read what another takes. Unmatched rows get NULL;
    of several matches the smallest row counts. A lookup of proven size is broadcast. Larger ones are joined by
    shuffles; the heavy keys of all of them come from one pass over ``df`` before the joins, so the plan reads the
    facts once, however many lookups there are. ``spread_by`` names columns that tell rows of one key apart.
    """
    wanted: dict[int, tuple[DataFrame, list[str]]] = {}
    for x in lookups:
        wanted.setdefault(id(x.table), (x.table, []))[1].extend([x.on[1], *x.take.values()])
    for table, columns in wanted.values():
        measure(table, columns)
    small = [x.is_small() for x in lookups]
    large = [x.on[0] for x, fits in zip(lookups, small) if not fits]
    heavy = heavy_keys(df, large) if large else {}
    joined = df
    for x, fits in zip(lookups, small):
        facts = joined.drop(*x.take)
        if fits:
            joined = attach(facts, F.broadcast(x.one), x.on[0])
        else:
            joined = attach(facts, x.one, x.on[0], heavy[x.on[0]], spread_by)
    return joined


def one_match(
    lookup: DataFrame, key: str, take: Mapping[str, str], newest: str | None = None
) -> DataFrame:
    """``lookup`` cut to one row per non-NULL key, as ``__key`` and the taken columns.

    The latest row by ``newest`` counts if that is named, then the smallest row.
    """
    columns = [F.col(src).alias(new) for new, src in take.items()]
    order = nulls_last(list(take))
    if newest:
        columns.append(F.col(newest).alias("__newest"))
        order.insert(0, F.col("__newest").desc_nulls_last())
    keyed = lookup.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), *columns)
    return first_per_key(keyed, ["__key"], order).select("__key", *take)


def heavy_keys(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[object, int]]:
    """Per column, its heavy keys and over how many reducers each is to be spread.

    A key is heavy if it has more rows than a reducer's even share. So there are fewer heavy keys than
    reducers, and a key is spread over as many reducers as it has shares.
    """
    reducers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = list(dict.fromkeys(columns))
    counts = df.groupingSets([[F.col(c)] for c in named], *named).agg(
        F.count("*").alias("__n"), F.grouping_id().alias("__set")
    )
    total = counts.groupBy("__set").agg(F.sum("__n").alias("__rows"))
    share = total.agg(F.max("__rows")).scalar() / F.lit(reducers)
    heavy: dict[str, dict[object, int]] = {c: {} for c in named}
    for row in counts.where(F.col("__n") > share).withColumn("__share", share).collect():
        # The bit of the only column of a grouping set is 0.
        (name,) = [c for i, c in enumerate(named) if not row["__set"] >> (len(named) - 1 - i) & 1]
        if row[name] is not None:
            heavy[name][row[name]] = min(reducers, math.ceil(row["__n"] / row["__share"]))
    return heavy


def attach(
    df: DataFrame,
    one: DataFrame,
    left_key: str,
    heavy: Mapping[object, int] | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Left join with a result of :func:`one_match`.

    With ``heavy`` keys, their rows get a salt from ``spread_by`` (all columns by default) below the number given, and
    the lookup row of such a key is repeated for every salt: no reducer has to take all rows of a hot key. Rows
    with a NULL key match nothing and are spread over all reducers.
    """
    if heavy is None:
        return df.join(one, F.col(left_key) == F.col("__key"), "left").drop("__key")
    spark = df.sparkSession
    reducers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = one.schema["__key"].dataType
    spread = T.StructType([T.StructField("__heavy", kind), T.StructField("__copies", T.IntegerType())])
    few = F.broadcast(spark.createDataFrame([tuple(x) for x in heavy.items()], spread))
    digest = F.xxhash64(*(spread_by or df.columns))
    copies = F.when(F.col(left_key).isNull(), reducers).otherwise(F.coalesce("__copies", F.lit(1)))
    left = (
        df.join(few, F.col(left_key) == F.col("__heavy"), "left")
        .withColumn("__left_salt", F.pmod(digest, copies).cast("int"))
        .drop("__heavy", "__copies")
    )
    every = F.sequence(F.lit(0), F.coalesce("__copies", F.lit(1)) - 1)
    right = one.join(few, F.col("__key") == F.col("__heavy"), "left").select(
        *one.columns, F.explode(every).alias("__salt")
    )
    matched = (F.col(left_key) == F.col("__key")) & (F.col("__left_salt") == F.col("__salt"))
    return left.join(right, matched, "left").drop("__key", "__left_salt", "__salt")


def unmatched(df: DataFrame, other: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Rows of ``df`` without a partner, duplicates and NULL keys included."""
    keys = other.select(F.col(on[1]).alias("__key"))
    return df.join(keys, F.col(on[0]) == F.col("__key"), "left_anti")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: repeated, or with a NULL part."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    counts = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counts.where((F.col("row_count") > 1) | missing)


def enforce_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` unchanged; the job fails as soon as a key is repeated or NULL.

    The window uses the partitioning and order that a following join on ``key`` needs anyway.
    """
    message = F.concat(F.lit(f"{key} is repeated or NULL: "), F.coalesce(F.col(key), F.lit("NULL")))
    nth = F.row_number().over(W.partitionBy(key).orderBy(key))
    broken = (F.col("__nth") > 1) | F.col(key).isNull()
    checked = F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("__nth", nth).where(checked).drop("__nth")
