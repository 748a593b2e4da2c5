"""Declared schemas, as text, and fitting a DataFrame to one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WATER_POINT_REPORT = """
    report_datetime timestamp_ntz, region string, district string, village string, dpid string,
    dpname string, wps string, dpcode string, latitude double, longitude double, populationserved int,
    yoc string, meternumber string, scheme string, schemetype string, servicearea string,
    paymenttype string, functionalitystatus string, organisation string, totalavailablegaps string,
    completeness string, ward string, servedbyagency string, lga string, institutioncategoryid string,
    institutionareaid string, sysid string, report_year string, quarter string,
    createdat timestamp_ntz
"""

# Columns of a water point report that are passed on only; a source without them gives NULL.
WATER_POINT_OPTIONAL = (
    "dpname wps dpcode yoc meternumber scheme schemetype servicearea paymenttype organisation"
    " totalavailablegaps completeness servedbyagency institutioncategoryid institutionareaid quarter createdat"
).split()

SCHOOL_SERVICE = """
    schoolregnumber string, reportdate date, haselectricity boolean, handwashingfacilities int,
    handwashingtype boolean, watersource string, electricitysource string, sanitarypadsprovided boolean,
    menstrualcounselor boolean, capitationgrant double, signedsitebook boolean,
    completioncertificate boolean
"""

SCHOOL_REPORT = """
    schoolregnumber string, regioncode string, lgacode string, gpscoordinates string,
    schoolpforrprogram boolean
"""

# The 28 described fields of a school's infrastructure.
SCHOOL_FACILITIES = """
    classroomcount int, classroomsrequired int, dispensaries int, dropholesboys int, dropholesgirls int,
    dropholesspecialneedsboys int, dropholesspecialneedsgirls int, dropholesmaleteachers int,
    dropholesfemaleteachers int, latrineslockable boolean, latrinesmaintained boolean,
    latrineshavewashablefloor boolean, latrineswithoutwastewaterdischarge boolean,
    latrinesconnectedstspcesspit boolean, responsibleforcleanlinesstoiletsboys string,
    responsibleforcleanlinesstoiletsgirls string, toilettypeftconnmainsewerline boolean,
    toilettypeftconnseptictank boolean, toilettypeftconnpit boolean, toilettypeftconnanotherloc boolean,
    toilettypevippitlatrine boolean, toilettypepitlatrinewithfloor boolean,
    toilettypeopenpitlatrine boolean, toilettypeothers boolean, burningchambers int, septictanks int,
    watertanks int, specialgirlsroom boolean
"""

SCHOOL_COMBINED = f"""
    schoolregnumber string, reportdate date, watersource string, region_code string, lga_code string,
    gps_coordinates string, schoolpforrprogram boolean, region_name string, lga_name string,
    {SCHOOL_FACILITIES.strip()}, school_category string, improved_water_source int,
    improved_toilet_type int, separate_latrines_teachers boolean, total_pupils double,
    girl_pupils double, boy_pupils double, girls_per_drophole double, boys_per_drophole double,
    enrollment_over1500 boolean, meet_drophole_ratio boolean, teacher_toilet_block boolean,
    drophole_specialneeds boolean, improved_sanitation_school int, haselectricity boolean,
    handwashingfacilities int, handwashingtype boolean, electricitysource string,
    sanitarypadsprovided boolean, menstrualcounselor boolean, capitationgrant double,
    signedsitebook boolean, completioncertificate boolean
"""

# A column of the mart that no rule fills.
SCHOOL_NOT_COMPUTED = ["teacher_toilet_block"]

QC_LOG = "id bigint, check_name string, result_value string, details string, log_time timestamp_ntz"

QUALITY_FLAGS = """
    id bigint, institution string, data_type string, error_alert_type string, description string,
    reportdate date, createdat timestamp_ntz, status string, resolution_remarks string,
    lastupdatedat timestamp_ntz
"""


def fields(schema: str) -> list[tuple[str, str]]:
    """(name, type) pairs; all declared types are plain."""
    return [tuple(field.split()) for field in schema.split(",")]


def names(schema: str) -> list[str]:
    return [name for name, _ in fields(schema)]


class MissingColumns(ValueError):
    """A table lacks columns that a plan needs."""

    def __init__(self, names: Sequence[str]):
        super().__init__(f"missing columns: {', '.join(names)}")
        self.names = list(names)


def actual(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` that ``name`` means under the session's case rule, if there is one."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive").lower() == "true":
        return name if name in df.columns else None
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def conform(df: DataFrame, schema: str, optional: Sequence[str] = ()) -> DataFrame:
    """The declared columns in order and type; an extra one is left out.

    A missing column that is not ``optional`` raises with its name; an optional one is NULL.
    """
    found = {name: actual(df, name) for name in names(schema)}
    missing = [name for name, own in found.items() if own is None and name not in optional]
    if missing:
        raise MissingColumns(missing)
    return df.select(
        *[
            (F.lit(None) if found[name] is None else F.col(f"`{found[name]}`")).cast(kind).alias(name)
            for name, kind in fields(schema)
        ]
    )


def run_number(run_ts: dt.datetime) -> int:
    """The first id of a run in the log tables: its seconds, then two digits."""
    return int(run_ts.replace(tzinfo=dt.timezone.utc).timestamp()) * 100
