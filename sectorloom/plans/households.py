"""Household sanitation: totals, capped rates, LGA means and quality flags."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.indicators import ALL_TOILETS, IMPROVED_TOILETS, toilet_total
from ..functions.ratios import capped_ratio, ratio
from ..operators.keyed import Lookup, lookup_joins
from ..sources.schemas import actual, run_number

RATES = ("improved_perc_hhs", "handwashstation_perc_hhs", "handwashsoap_perc_hhs")
INSTITUTION = "MOH"
DATA_TYPE = "householdsanitation"


def check_computed(reports: DataFrame) -> None:
    """Raise if a column that the rates add exists in the reports as one that can't hold a number."""
    for name in ("totalhouseholds", "improved_count_hhs", *RATES):
        own = actual(reports, name)
        if own and not isinstance(reports.schema[own].dataType, T.NumericType):
            raise TypeError(f"column {own} is not a number")


def household_rates(reports: DataFrame) -> DataFrame:
    """All raw columns with household totals and rates capped at 1."""
    total = F.col("totalhouseholds")
    return reports.withColumns(
        {
            "totalhouseholds": toilet_total(ALL_TOILETS),
            "improved_count_hhs": toilet_total(IMPROVED_TOILETS),
        }
    ).withColumns(
        {
            "improved_perc_hhs": capped_ratio(F.col("improved_count_hhs"), total),
            "handwashstation_perc_hhs": capped_ratio(F.col("handwashingstation"), total),
            "handwashsoap_perc_hhs": capped_ratio(F.col("hwfsoapwater"), total),
        }
    )


def with_region_name(df: DataFrame, regions: DataFrame) -> DataFrame:
    return lookup_joins(df, [region_lookup(regions)])


def with_lga(df: DataFrame, lgas: DataFrame, include_geojson: bool = True) -> DataFrame:
    return lookup_joins(df, [lga_lookup(lgas, include_geojson)])


def region_lookup(regions: DataFrame) -> Lookup:
    return Lookup(regions, ("regioncode", "household_regioncode"), {"region_name": "name"})


def lga_lookup(lgas: DataFrame, include_geojson: bool = True) -> Lookup:
    take = {"lga_name": "lganame"}
    if include_geojson:
        take["geojson"] = "geojson"
    return Lookup(lgas, ("lgacode", "household_lgacode"), take)


def household_detail(
    reports: DataFrame, regions: DataFrame, lgas: DataFrame, include_geojson: bool = True
) -> DataFrame:
    return with_names(household_rates(reports), regions, lgas, include_geojson)


def with_names(
    rates: DataFrame, regions: DataFrame, lgas: DataFrame, include_geojson: bool = True
) -> DataFrame:
    return lookup_joins(rates, [region_lookup(regions), lga_lookup(lgas, include_geojson)])


def lga_means(rates: DataFrame, regions: DataFrame, lgas: DataFrame) -> DataFrame:
    """Mean rates per LGA, date and region; rows with an unknown mean are left out.

    Names and shapes depend on the codes alone and are attached after grouping, so no shape is shuffled
    with the reports.
    """
    means = rates.groupBy("lgacode", "reportdate", "regioncode").agg(*_means())
    known = means.dropna(subset=[f"avg_{r}" for r in RATES])
    return with_names(known, regions, lgas)


def lga_means_by_date(rates: DataFrame, regions: DataFrame, lgas: DataFrame) -> DataFrame:
    """Mean rates per named LGA and date, labelled by the region of the report created first.

    The large aggregate keeps numbers only, so that it runs hash-based with map-side combining; the first
    region is picked among its few rows per LGA and date. No row is joined back to the details.
    """
    known = rates.where(F.col("lgacode").isNotNull() & F.col("reportdate").isNotNull())
    sums = rate_sums(known, ["lgacode", "reportdate", "regioncode"], F.min("createdat").alias("first"))
    earliest = F.struct(
        F.col("first").isNull().alias("undated"),
        F.col("first"),
        F.col("regioncode").isNull().alias("no_region"),
        F.col("regioncode"),
    )
    means = (
        sums.groupBy("lgacode", "reportdate")
        .agg(
            F.min(earliest).alias("earliest"),
            *[ratio(F.sum(f"sum_{r}"), F.sum(f"n_{r}")).alias(f"avg_{r}") for r in RATES],
        )
        .withColumn("regioncode", F.col("earliest.regioncode"))
        .drop("earliest")
    )
    named = with_lga(means, lgas).where(F.col("lga_name").isNotNull())
    return with_region_name(named, regions)


def rate_sums(df: DataFrame, keys: Sequence[str], *extra: Column) -> DataFrame:
    """Sum and known count of each rate per key, to be combined further."""
    sums = [F.sum(r).alias(f"sum_{r}") for r in RATES]
    counts = [F.count(r).alias(f"n_{r}") for r in RATES]
    return df.groupBy(*keys).agg(*sums, *counts, *extra)


def _means():
    return [F.avg(r).alias(f"avg_{r}") for r in RATES]


def quality_flags(detail: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One flag per failed check, from a single pass over the detail rows."""
    counts = detail.agg(
        F.count_if(F.col("totalhouseholds") == 0).alias("zero_total"),
        F.count_if(F.col("regioncode").isNotNull() & F.col("region_name").isNull()).alias("region"),
        F.count_if(F.col("lgacode").isNotNull() & F.col("lga_name").isNull()).alias("lga"),
    )
    # Kind, text and remark of each flag.
    checks = [
        (
            "zero_total",
            "unrealistic_values",
            "Rows with computed totalhouseholds = 0",
            "Review raw data for inconsistencies",
        ),
        (
            "region",
            "missing_data",
            "Rows with non-null regioncode but null region_name",
            "Verify lookup table for regions",
        ),
        (
            "lga",
            "missing_data",
            "Rows with non-null lgacode but null lga_name",
            "Verify lookup table for LGAs",
        ),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(run_number(run_ts) + i).cast("bigint").alias("id"),
                F.col(count).alias("n"),
                F.lit(kind).alias("error_alert_type"),
                F.lit(text).alias("description"),
                F.lit(remark).alias("resolution_remarks"),
            )
            for i, (count, kind, text, remark) in enumerate(checks, start=1)
        ]
    )
    flags = counts.select(F.inline(rows)).where(F.col("n") > 0)
    return flag_columns(flags, run_ts)


def flag_columns(flags: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Complete flag rows with the constants of one run, in the order of the flag table."""
    stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return flags.select(
        "id",
        F.lit(INSTITUTION).alias("institution"),
        F.lit(DATA_TYPE).alias("data_type"),
        "error_alert_type",
        "description",
        stamp.cast("date").alias("reportdate"),
        stamp.alias("createdat"),
        F.lit("pending").alias("status"),
        "resolution_remarks",
        stamp.alias("lastupdatedat"),
    )
