"""Quality checks of the school mart and its sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.indicators import LARGE_SCHOOL, no_toilet_type_known
from ..functions.periods import within_year
from ..functions.ratios import percent
from ..operators.shares import share_of_total
from ..sources.schemas import QC_LOG, SCHOOL_FACILITIES, conform, names, run_number
from .schools import KEY

KEY_TABLE = "qc_keys"

# The checks in the order of the log.
CHECKS = (
    "unique_schools_services",
    "unique_schools_reports",
    "matched_services_reports",
    "unmatched_services_not_in_reports",
    "unmatched_reports_not_in_services",
    "missing_region_lga_names",
    "unique_schools_infrastructure",
    "matched_combined_infrastructure",
    "infra_not_in_combined",
    "combined_not_in_infra",
    "school_category_counts",
    "null_watersource_count",
    "null_improved_toilet_type",
    "enrollment_totals",
    "enrollment_over_under_1500",
    "meet_drophole_ratio_count",
    "separate_latrines_teachers_count",
    "percent_improved_sanitation",
    "enrollment_mismatches",
)
LISTED = (
    "unmatched_services_not_in_reports",
    "unmatched_reports_not_in_services",
    "missing_region_lga_names",
    "infra_not_in_combined",
    "combined_not_in_infra",
    "enrollment_mismatches",
)


def key_presence(
    services: DataFrame,
    reports: DataFrame,
    infrastructure: DataFrame,
    combined: DataFrame,
    year: int,
) -> DataFrame:
    """Per school number, its row count in every source.

    One aggregate replaces the inner and anti joins between the sources: a hot number shrinks to one
    row per map task and a number is matched when both counts are above zero.
    """
    in_year = within_year(F.col("reportdate"), year)
    tagged = [
        services.select(
            KEY,
            F.lit(1).alias("services"),
            F.when(in_year, 1).otherwise(0).alias("services_year"),
        ),
        reports.select(KEY, F.lit(1).alias("reports")),
        infrastructure.select(KEY, F.lit(1).alias("infrastructure")),
        combined.select(KEY, F.lit(1).alias("combined")),
    ]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    counted = ["services", "services_year", "reports", "infrastructure", "combined"]
    return rows.groupBy(KEY).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted])


def _absent(other: str) -> Column:
    """A NULL number has no partner, as in an anti join."""
    return F.col(KEY).isNull() | (F.col(other) == 0)


def _both(left: str, right: str) -> Column:
    return F.col(KEY).isNotNull() & (F.col(left) > 0) & (F.col(right) > 0)


def _unmatched_rows() -> dict[str, Column]:
    return {
        "unmatched_services_not_in_reports": F.when(_absent("reports"), F.col("services_year")),
        "unmatched_reports_not_in_services": F.when(_absent("services"), F.col("reports")),
        "infra_not_in_combined": F.when(_absent("combined"), F.col("infrastructure")),
        "combined_not_in_infra": F.when(_absent("infrastructure"), F.col("combined")),
    }


def _school_tests() -> dict[str, Column]:
    return {
        "missing_region_lga_names": F.col("region_name").isNull() | F.col("lga_name").isNull(),
        "enrollment_mismatches": F.col("boy_pupils") + F.col("girl_pupils")
        != F.col("total_pupils"),
    }


def presence_results(presence: DataFrame) -> DataFrame:
    """Results of the checks between sources."""
    known = F.col(KEY).isNotNull()
    counts = {
        "unique_schools_services": F.count_if(known & (F.col("services_year") > 0)),
        "unique_schools_reports": F.count_if(known & (F.col("reports") > 0)),
        "matched_services_reports": F.count_if(_both("services_year", "reports")),
        "unique_schools_infrastructure": F.count_if(known & (F.col("infrastructure") > 0)),
        "matched_combined_infrastructure": F.count_if(_both("combined", "infrastructure")),
    }
    for name, rows in _unmatched_rows().items():
        counts[name] = F.coalesce(F.sum(rows), F.lit(0))
    totals = presence.agg(*[c.alias(n) for n, c in counts.items()])
    return _as_rows(totals, {n: (F.col(n).cast("string"), None) for n in counts})


def school_results(combined: DataFrame) -> DataFrame:
    """Results of the checks on the mart, in one pass grouped by school category."""
    pupils = F.col("total_pupils")
    per_category = combined.groupBy("school_category").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("watersource").isNull()).alias("no_source"),
        F.count_if(F.col("improved_toilet_type").isNull()).alias("no_toilet"),
        F.sum("boy_pupils").alias("boys"),
        F.sum("girl_pupils").alias("girls"),
        F.sum("total_pupils").alias("pupils"),
        F.sum(F.when(pupils >= LARGE_SCHOOL, 1).otherwise(0)).alias("large"),
        F.sum(F.when(pupils < LARGE_SCHOOL, 1).otherwise(0)).alias("small"),
        F.count_if("meet_drophole_ratio").alias("ratio_met"),
        F.count_if("separate_latrines_teachers").alias("teacher_latrines"),
        F.count_if(F.col("improved_sanitation_school") == 1).alias("improved"),
        *[F.count_if(test).alias(name) for name, test in _school_tests().items()],
    )
    sums = ["n", "no_source", "no_toilet", "boys", "girls", "pupils", "large", "small"]
    sums += ["ratio_met", "teacher_latrines", "improved", *_school_tests()]
    entry = F.concat("school_category", F.lit(":"), F.col("n").cast("string"))
    totals = per_category.agg(
        F.array_join(F.array_sort(F.collect_list(entry)), ", ").alias("categories"),
        *[F.sum(c).alias(c) for c in sums],
    )
    return _as_rows(
        totals,
        {
            "missing_region_lga_names": (_count("missing_region_lga_names"), None),
            "school_category_counts": (None, F.nullif(F.col("categories"), F.lit(""))),
            "null_watersource_count": (_count("no_source"), None),
            "null_improved_toilet_type": (_count("no_toilet"), None),
            "enrollment_totals": (
                None,
                F.concat(
                    F.lit("boys:"),
                    _plain("boys"),
                    F.lit(", girls:"),
                    _plain("girls"),
                    F.lit(", total:"),
                    _plain("pupils"),
                ),
            ),
            "enrollment_over_under_1500": (
                None,
                F.concat(F.lit("over_1500:"), "large", F.lit(", under_1500:"), "small"),
            ),
            "meet_drophole_ratio_count": (_count("ratio_met"), None),
            "separate_latrines_teachers_count": (_count("teacher_latrines"), None),
            "percent_improved_sanitation": (
                percent(F.col("improved"), F.col("n"), 6).cast("string"),
                None,
            ),
            "enrollment_mismatches": (_count("enrollment_mismatches"), None),
        },
    )


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("string")


def _plain(name: str) -> Column:
    """A sum as text without exponent or trailing zeros; NULL as 0."""
    digits = F.coalesce(F.col(name), F.lit(0)).cast("decimal(38,4)").cast("string")
    return F.regexp_replace(digits, r"\.?0+$", "")


def _as_rows(
    totals: DataFrame, results: Mapping[str, tuple[Column | None, Column | None]]
) -> DataFrame:
    """Turn one row of totals into a log row per check."""
    missing = F.lit(None).cast("string")
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            (missing if value is None else value).alias("result_value"),
            (missing if text is None else text).alias("details"),
        )
        for name, (value, text) in results.items()
    ]
    return totals.select(F.inline(F.array(*rows)))


def failing_keys(presence: DataFrame, combined: DataFrame) -> DataFrame:
    """Every school number that a listing check reports, with its row count.

    This is the whole listing at any size: one row per check and number, never gathered into one text.
    """
    between = presence.select(KEY, F.inline(_findings(_unmatched_rows())))
    tests = {n: F.when(t, F.lit(1)).cast("bigint") for n, t in _school_tests().items()}
    within = combined.select(KEY, F.inline(_findings(tests)))
    return (
        between.unionByName(within).where(F.col("row_count") > 0).select("check_name", KEY, "row_count")
    )


def _findings(rows: Mapping[str, Column]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), count.alias("row_count"))
            for name, count in rows.items()
        ]
    )


def qc_log(presence: DataFrame, combined: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The log of one run: a row per check, in the order of :data:`CHECKS`.

    Of a listing check the log has the number of rows and the name of the table that lists them, whatever their
    number. Ids are unique over runs: the seconds of the run, then two digits for the check.
    """
    return _logged(presence_results(presence).unionByName(school_results(combined)), run_ts)


def presence_log(presence: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The part of :func:`qc_log` that compares the sources."""
    return _logged(presence_results(presence), run_ts)


def _logged(results: DataFrame, run_ts: dt.datetime) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(c) for c in CHECKS]), F.col("check_name"))
    stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    logged = results.withColumns(
        {
            "id": run_number(run_ts) + order.cast("bigint"),
            "details": F.when(F.col("check_name").isin(*LISTED), KEY_TABLE).otherwise(F.col("details")),
            "log_time": stamp,
        }
    )
    return conform(logged, QC_LOG)


# --- distributions and profiles ----------------------------------------------


def toilet_share(combined: DataFrame) -> DataFrame:
    return share_of_total(combined, "improved_toilet_type")


def water_share(combined: DataFrame) -> DataFrame:
    return share_of_total(combined, "improved_water_source")


def uncoded_sources(combined: DataFrame) -> DataFrame:
    """Water sources that no pattern codes, with their share of all uncoded rows."""
    return share_of_total(combined.where(F.col("improved_water_source").isNull()), "watersource")


def no_toilet_type(combined: DataFrame) -> DataFrame:
    """Schools where every toilet type flag is NULL."""
    return combined.where(no_toilet_type_known()).select(KEY)


def table_counts(tables: Mapping[str, DataFrame], low: int, high: int) -> DataFrame:
    """Rows and schools per source, with an alert outside [low, high]."""
    parts = [
        df.groupBy(KEY)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count(KEY).alias("school_count"),
        )
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    rows = F.col("row_count")
    return counts.withColumn(
        "alert", F.when(rows < low, "low").when(rows > high, "high").otherwise("ok")
    )


def null_profile(infrastructure: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs per facility field, as a percentage of the schools of the largest source."""
    facilities = names(SCHOOL_FACILITIES)
    rows = conform(infrastructure, SCHOOL_FACILITIES)
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in facilities])
    largest = table_counts(tables, 0, 0).agg(F.max("school_count").alias("n")).scalar()
    return (
        counts.unpivot([], facilities, "field", "null_count")
        .withColumn("school_count", largest)
        .withColumn("null_percentage", percent(F.col("null_count"), F.col("school_count"), 2))
    )
