"""Water point status, functionality rates and the latest located report of each point."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.indicators import OPERATING, status_flags
from ..functions.periods import full_months_before, period_start, year_stamp
from ..functions.ratios import ratio
from ..operators.keyed import Lookup, first_per_key, lookup_joins, nulls_last
from ..operators.shares import share_of_total
from ..sources.schemas import WATER_POINT_OPTIONAL, WATER_POINT_REPORT, actual, conform
from .lookups import district_labels, district_lookup

YEAR = ("year_timestamp",)
QUARTER = ("year_timestamp", "quarter_timestamp")


def status_detail(reports: DataFrame) -> DataFrame:
    """One row per report with period keys and status indicators, without names."""
    status = F.col("functionalitystatus")
    raw = conform(reports, WATER_POINT_REPORT, WATER_POINT_OPTIONAL)
    return raw.withColumnRenamed("district", "district_code").select(
        "*",
        year_stamp(F.col("report_year")).alias("year_timestamp"),
        period_start(F.col("report_datetime"), "month").alias("month_timestamp"),
        period_start(F.col("report_datetime"), "quarter").alias("quarter_timestamp"),
        *[flag.alias(name) for name, flag in status_flags(status).items()],
    )


def water_point_detail(reports: DataFrame, admin: DataFrame) -> DataFrame:
    return district_labels(status_detail(reports), admin)


def detail_by_month(reports: DataFrame, admin: DataFrame) -> DataFrame:
    """:func:`water_point_detail` with its rows spread by ``month_timestamp``, a hot month over several tasks.

    Only the columns that the reports have are shuffled; absent ones, periods, flags and labels are added to the spread
    rows. Labels that are too large for a broadcast need a shuffle by district, so there the result is spread.
    """
    labels = district_lookup(admin)
    detail = status_detail(reports)
    if not labels.is_small():
        return lookup_joins(detail, [labels]).hint("rebalance", F.col("month_timestamp"))
    moment = F.col(f"`{actual(reports, 'report_datetime')}`").cast("timestamp_ntz")
    spread = reports.withColumn("__month", period_start(moment, "month")).hint("rebalance", F.col("__month"))
    return lookup_joins(status_detail(spread), [labels])


def status_share(reports: DataFrame) -> DataFrame:
    return share_of_total(reports, "functionalitystatus")


def district_rates(detail: DataFrame, admin: DataFrame, period: tuple[str, ...] = YEAR) -> DataFrame:
    """Indicators per district and period.

    The yearly rate is a percentage and the quarterly rate a fraction, as the published marts have them.
    Region and district names depend on the district code alone, so they are attached to the few grouped
    rows and not to the reports.
    """
    scale = 100 if period == YEAR else 1
    grouped = detail.groupBy("district_code", *period).agg(
        F.avg("wp_abandoned_archived").alias("avg_wp_abandoned"),
        F.sum("wp_functional").alias("sum_wp_functional"),
        F.avg("wp_functional_needs_repair").alias("avg_wp_functional_needs_repair"),
        F.avg("wp_non_functional").alias("avg_wp_non_functional"),
        F.avg("wp_inconstruction").alias("avg_in_construction"),
        F.avg("wp_status_numeric").alias("functionality_rate"),
        F.sum("wp_func_denominator").alias("func_denom"),
    )
    rate = ratio(F.col("sum_wp_functional"), F.col("func_denom")) * scale
    return district_labels(grouped.withColumn("func_rate_new", rate), admin)


def without_functional(rates: DataFrame) -> DataFrame:
    """Districts and periods in which no operating status was reported."""
    return rates.where(F.col("func_denom") == 0)


def latest_located(
    detail: DataFrame, admin: DataFrame, villages: DataFrame, as_of: dt.date, months: int = 3
) -> DataFrame:
    """The latest located report per water point in the full months before ``as_of``.

    The window covers whole months, so the month key is filtered as well: on a mart partitioned by month
    only those partitions are read.
    """
    start, stop = full_months_before(as_of, months)
    kept = [
        "dpid",
        "region",
        "district_code",
        "lga",
        "village",
        F.col("ward").alias("ward_name"),
        "functionalitystatus",
        "populationserved",
        "latitude",
        "longitude",
        "report_datetime",
        "sysid",
    ]
    in_window = detail.where(
        F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("functionalitystatus").isin(*OPERATING)
        & (F.col("report_datetime") >= start)
        & (F.col("report_datetime") < stop)
        & (F.col("month_timestamp") >= start)
        & (F.col("month_timestamp") < stop)
    ).select(*kept)
    others = [c for c in in_window.columns if c not in ("dpid", "report_datetime", "sysid")]
    order = [F.col("report_datetime").desc(), *nulls_last(["sysid", *others])]
    latest = first_per_key(in_window, ["dpid"], order)

    lookups = [
        Lookup(admin, ("region", "region_code"), {"region_name": "region_name"}),
        Lookup(admin, ("district_code", "district_code"), {"district_name": "district_name"}),
        Lookup(admin, ("lga", "lga_code"), {"lga_name": "lga_name", "geojson": "geojson"}),
        Lookup(villages, ("village", "villagecode"), {"village_name": "villagename"}),
    ]
    return lookup_joins(latest, lookups, ["dpid"]).select(
        "dpid",
        "region_name",
        "district_name",
        "lga_name",
        "village_name",
        "ward_name",
        "functionalitystatus",
        "populationserved",
        "latitude",
        "longitude",
        "report_datetime",
        "geojson",
    )
