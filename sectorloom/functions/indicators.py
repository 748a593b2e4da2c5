"""Business rules for derived columns. NULL behaviour is part of each rule."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ratios import ratio

# Water point statuses.
FUNCTIONAL = "functional"
NEEDS_REPAIR = "functional_need_repair"
NOT_FUNCTIONAL = "not_functional"
ABANDONED = "abandoned"
ARCHIVED = "archived"
ON_CONSTRUCTION = "on_construction"
OPERATING = (FUNCTIONAL, NOT_FUNCTIONAL, NEEDS_REPAIR)

# Toilet types of the household reports.
ALL_TOILETS = ("a", "b", "c", "d", "e", "f", "x")
IMPROVED_TOILETS = ("b", "c", "d", "e")

# Text patterns of school water sources.
IMPROVED_WATER = (
    "%default%",
    "%maji ya bomba%",
    "%maji ya mvua%",
    "%visima vifupi%",
    "%visima vilivyojengwa%",
    "%visima vifupi vilivyofungwa pampu za mikono%",
)
UNIMPROVED_WATER = ("%maji ya mto%", "%bwawa%", "%maji ya ziwa%", "%chemchem%")

# School toilet flags.
IMPROVED_TOILET_FLAGS = (
    "toilettypeftconnmainsewerline",
    "toilettypeftconnseptictank",
    "toilettypeftconnpit",
    "toilettypevippitlatrine",
)
UNIMPROVED_TOILET_FLAGS = (
    "toilettypeftconnanotherloc",
    "toilettypepitlatrinewithfloor",
    "toilettypeopenpitlatrine",
    "toilettypeothers",
)

# School categories and the size and ratio limits.
PRIMARY, SECONDARY, UNKNOWN = "Primary/Pre-Primary", "Secondary", "Unknown"
LARGE_SCHOOL = 1500
GIRLS_LIMIT, BOYS_LIMIT = 40, 50
LARGE_GIRLS_LIMIT, LARGE_BOYS_LIMIT = 50, 65


def one_if(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(condition, 1).otherwise(0)


def any_true(columns) -> Column:
    return reduce(or_, [F.coalesce(F.col(c), F.lit(False)) for c in columns])


def total_of(columns) -> Column:
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


# --- water points -----------------------------------------------------------


def status_flags(status: Column) -> dict[str, Column]:
    return {
        "wp_functional": one_if(status == FUNCTIONAL),
        "wp_functional_needs_repair": one_if(status == NEEDS_REPAIR),
        "wp_non_functional": one_if(status == NOT_FUNCTIONAL),
        "wp_abandoned_archived": one_if(status.isin(ABANDONED, ARCHIVED)),
        "wp_inconstruction": one_if(status == ON_CONSTRUCTION),
        "wp_func_denominator": one_if(status.isin(*OPERATING)),
        "wp_status_numeric": F.when(status == FUNCTIONAL, 1.0)
        .when(status == NEEDS_REPAIR, 0.5)
        .when(status.isin(NOT_FUNCTIONAL, ABANDONED), 0.0),
    }


# --- households -------------------------------------------------------------


def toilet_total(kinds) -> Column:
    return total_of([f"toilettype{k}" for k in kinds])


# --- villages ---------------------------------------------------------------


def village_counts() -> dict[str, Column]:
    """Sums that skip unknown conditions and stay NULL when a group has no known one."""
    active = (F.col("status") == 1) & F.col("isvillage")
    service = F.col("servicetype")
    tests = {
        "villages_in_lga": active,
        "villages_with_service": active & (service != "no_service"),
        "villages_no_service": active & (service == "no_service"),
        "served_by_wssa": active & ~F.col("servedbyagency"),
    }
    return {name: F.sum(test.cast("int")).alias(name) for name, test in tests.items()}


# --- schools ----------------------------------------------------------------


def school_category(number: Column) -> Column:
    prefix = F.split_part(number, F.lit("."), F.lit(1))
    return (
        F.when(prefix.isin("EM", "ES"), PRIMARY)
        .when(prefix == "S", SECONDARY)
        .otherwise(UNKNOWN)
    )


def improved_water_source(source: Column) -> Column:
    def matches(patterns):
        return reduce(or_, [source.ilike(p) for p in patterns])

    return F.when(matches(IMPROVED_WATER), 1).when(matches(UNIMPROVED_WATER), 0)


def improved_toilet_type() -> Column:
    """An unimproved flag wins over an improved one."""
    return F.when(any_true(UNIMPROVED_TOILET_FLAGS), 0).when(any_true(IMPROVED_TOILET_FLAGS), 1)


def no_toilet_type_known() -> Column:
    flags = IMPROVED_TOILET_FLAGS + UNIMPROVED_TOILET_FLAGS
    return F.coalesce(*[F.col(c) for c in flags]).isNull()


def latrines_lockable() -> Column:
    implied = any_true(["latrinesmaintained", "specialgirlsroom"]) | F.col(
        "schoolregnumber"
    ).startswith("EM")
    return implied | F.coalesce(F.col("latrineslockable"), F.lit(False))


def drophole_special_needs() -> Column:
    return F.coalesce(F.col("dropholesspecialneedsboys") > 0, F.lit(False)) | F.coalesce(
        F.col("dropholesspecialneedsgirls") > 0, F.lit(False)
    )


def pupils_per_drophole(pupils: Column, holes: Column) -> Column:
    return ratio(pupils, holes)


def meets_drophole_ratio() -> Column:
    """Never NULL: an unknown part makes the school fail."""
    girls, boys = F.col("girls_per_drophole"), F.col("boys_per_drophole")
    large = F.col("enrollment_over1500")
    small_ok = ~large & (girls <= GIRLS_LIMIT) & (boys <= BOYS_LIMIT)
    large_ok = large & (girls <= LARGE_GIRLS_LIMIT) & (boys <= LARGE_BOYS_LIMIT)
    return F.col("drophole_specialneeds") & (
        F.coalesce(small_ok, F.lit(False)) | F.coalesce(large_ok, F.lit(False))
    )


def separate_teacher_latrines() -> Column:
    men, women = F.col("dropholesmaleteachers"), F.col("dropholesfemaleteachers")
    return F.when(men.isNull() | women.isNull(), F.lit(None)).otherwise((men > 0) & (women > 0))


def improved_sanitation() -> Column:
    toilet, holes = F.col("improved_toilet_type"), F.col("meet_drophole_ratio")
    teachers = F.col("separate_latrines_teachers")
    unknown = toilet.isNull() | holes.isNull() | teachers.isNull()
    return F.when(~unknown, one_if((toilet == 1) & holes & teachers))
