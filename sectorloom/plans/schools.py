"""One assessed row per school from services, reports, infrastructure and enrollment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import indicators as ind
from ..functions.periods import within_year
from ..operators.keyed import attach, enforce_key, lookup_join, one_match
from ..sources.schemas import (
    SCHOOL_COMBINED,
    SCHOOL_FACILITIES,
    SCHOOL_NOT_COMPUTED,
    SCHOOL_REPORT,
    SCHOOL_SERVICE,
    actual,
    conform,
    names,
)

KEY = "schoolregnumber"
# Pupil counts, which arrive as text.
COUNTS = ("totalpupils", "totalgirls", "totalboys")


def services_of_year(services: DataFrame, year: int) -> DataFrame:
    return conform(services.where(within_year(F.col("reportdate"), year)), SCHOOL_SERVICE)


def school_combined(
    services: DataFrame,
    reports: DataFrame,
    infrastructure: DataFrame,
    enrollment: DataFrame,
    admin: DataFrame,
    year: int,
) -> DataFrame:
    """The school mart of one year; fails if a school has two service rows in it.

    All four sources meet on the registration number, so each is shuffled once and the joins share that
    partitioning.
    """
    schools = enforce_key(services_of_year(services, year), KEY)
    schools = _attach(
        schools,
        reports,
        {
            "region_code": "regioncode",
            "lga_code": "lgacode",
            "gps_coordinates": "gpscoordinates",
            "schoolpforrprogram": "schoolpforrprogram",
        },
        SCHOOL_REPORT,
    )
    schools = _attach(
        schools,
        infrastructure.where(within_year(F.col("reportdate"), year)),
        {c: c for c in names(SCHOOL_FACILITIES)},
        f"{KEY} string, {SCHOOL_FACILITIES}",
    )
    schools = _attach(
        schools,
        enrollment.withColumns({c: F.col(c).try_cast("double") for c in COUNTS}),
        {"total_pupils": "totalpupils", "girl_pupils": "totalgirls", "boy_pupils": "totalboys"},
        f"{KEY} string, totalpupils double, totalgirls double, totalboys double",
    )
    schools = lookup_join(
        schools,
        admin,
        ("lga_code", "school_lgacode"),
        {"region_name": "region_name", "lga_name": "lga_name"},
        spread_by=[KEY],
    )
    return conform(assess(schools), SCHOOL_COMBINED, SCHOOL_NOT_COMPUTED)


def _attach(schools: DataFrame, source: DataFrame, take: dict[str, str], ddl: str) -> DataFrame:
    """Left join on the school number; of several rows the latest report counts."""
    newest = "reportdate" if actual(source, "reportdate") else None
    columns = f"{ddl}, reportdate date" if newest else ddl
    return attach(schools, one_match(conform(source, columns), KEY, take, newest), KEY)


def rejected_counts(enrollment: DataFrame) -> DataFrame:
    """Every pupil count that is given but can't be read, which the mart takes as NULL, in one pass without a shuffle."""
    found = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(),
            F.struct(
                F.lit("school_enrollment").alias("table_name"),
                F.col(KEY).alias(KEY),
                F.lit(c).alias("column_name"),
                F.col(c).cast("string").alias("value"),
                F.lit("not a number").alias("reason"),
            ),
        )
        for c in COUNTS
    ]
    return enrollment.select(F.inline(F.array_compact(F.array(*found))))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected values per column and reason, and of how many schools."""
    return rejects.groupBy("table_name", "column_name", "reason").agg(
        F.count("*").alias("row_count"), F.countDistinct(KEY).alias("school_count")
    )


def assess(schools: DataFrame) -> DataFrame:
    """Indicators of a joined school row. Each step reads columns of the steps before."""
    return (
        schools.withColumns(
            {
                "school_category": ind.school_category(F.col(KEY)),
                "improved_water_source": ind.improved_water_source(F.col("watersource")),
                "improved_toilet_type": ind.improved_toilet_type(),
                "latrineslockable": ind.latrines_lockable(),
                "latrinesmaintained": F.coalesce("latrinesmaintained", F.lit(False)),
                "specialgirlsroom": F.coalesce("specialgirlsroom", F.lit(False)),
                "girls_per_drophole": ind.pupils_per_drophole(
                    F.col("girl_pupils"), F.col("dropholesgirls")
                ),
                "boys_per_drophole": ind.pupils_per_drophole(
                    F.col("boy_pupils"), F.col("dropholesboys")
                ),
                "drophole_specialneeds": ind.drophole_special_needs(),
                "enrollment_over1500": F.col("total_pupils") >= ind.LARGE_SCHOOL,
                "separate_latrines_teachers": ind.separate_teacher_latrines(),
            }
        )
        .withColumn("meet_drophole_ratio", ind.meets_drophole_ratio())
        .withColumn("improved_sanitation_school", ind.improved_sanitation())
    )
