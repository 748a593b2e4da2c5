"""Cross-sector scorecard per LGA."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.indicators import village_counts
from ..functions.ratios import percent
from ..operators.keyed import attach, heavy_keys, lookup_join, one_match
from ..operators.sizing import fits_in_broadcast
from .households import rate_sums

HOUSEHOLD_COLUMNS = [
    "lga_improved_san_perc_hhs",
    "lga_handwashstation_perc_hhs",
    "lga_handwashsoap_perc_hhs",
    "regioncode",
    "region_name",
]
SCHOOL_COLUMNS = ["lga_school_improved_water_perc", "lga_school_improved_toilet_type_perc"]


def service_levels(villages: DataFrame) -> DataFrame:
    """Access level and village counts per LGA."""
    return villages.groupBy("lgacode").agg(
        F.avg("infracoverage").alias("lga_water_access_level_perc"), *village_counts().values()
    )


def household_scores(detail: DataFrame) -> DataFrame:
    """Scores per LGA. Rates are summed per label first: the smallest label is then taken among few rows."""
    sums = rate_sums(detail, ["lgacode", "regioncode", "region_name"])
    scores = {
        "improved_perc_hhs": "lga_improved_san_perc_hhs",
        "handwashstation_perc_hhs": "lga_handwashstation_perc_hhs",
        "handwashsoap_perc_hhs": "lga_handwashsoap_perc_hhs",
    }
    return sums.groupBy("lgacode").agg(
        F.min("regioncode").alias("regioncode"),
        F.min("region_name").alias("region_name"),
        *[
            percent(F.sum(f"sum_{rate}"), F.sum(f"n_{rate}"), 1).alias(score)
            for rate, score in scores.items()
        ],
    )


def school_scores(combined: DataFrame) -> DataFrame:
    scores = {
        "improved_water_source": "lga_school_improved_water_perc",
        "improved_toilet_type": "lga_school_improved_toilet_type_perc",
    }
    return combined.groupBy("lga_code").agg(
        *[percent(F.sum(flag), F.count(flag), 1).alias(score) for flag, score in scores.items()]
    )


def lga_scorecard(
    lgas: DataFrame,
    districts: DataFrame,
    households: DataFrame,
    schools: DataFrame,
    district_year: DataFrame,
    levels: DataFrame,
) -> DataFrame:
    """One row per LGA. Every large source comes in already grouped; the functionality rate is that of
    the district's latest year.

    The grouped sources are not measured, which would run them twice. Instead the LGAs are: only when they
    are many can one of their codes be hot enough to need spreading.
    """
    card = lookup_join(
        lgas, districts, ("districtcode", "districtcode"), {"district_name": "districtname"}
    )
    sources = [
        (households, ("household_lgacode", "lgacode"), HOUSEHOLD_COLUMNS, None),
        (schools, ("school_lgacode", "lga_code"), SCHOOL_COLUMNS, None),
        (district_year, ("districtcode", "district_code"), ["func_rate_new"], "year_timestamp"),
        (levels, ("lgacode", "lgacode"), ["lga_water_access_level_perc"], None),
    ]
    codes = [on[0] for _, on, _, _ in sources]
    heavy = None if fits_in_broadcast(lgas, codes) else heavy_keys(lgas, codes)
    for source, (code, key), columns, newest in sources:
        one = one_match(source, key, {c: c for c in columns}, newest)
        card = attach(card, one, code, heavy and heavy[code], ["lgacode"])
    return card.select(
        "lgacode",
        "household_lgacode",
        "school_lgacode",
        "lganame",
        "districtcode",
        "district_name",
        "geojson",
        *HOUSEHOLD_COLUMNS,
        *SCHOOL_COLUMNS,
        "func_rate_new",
        "lga_water_access_level_perc",
    )
