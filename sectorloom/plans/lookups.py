"""Region, district and LGA lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import Lookup, lookup_join, lookup_joins, unmatched

SHAPE_NAME = "`Authority`"


def lgas_with_shape(lgas: DataFrame, shapes: DataFrame) -> DataFrame:
    """All LGAs with the shape whose authority has the same name, if there is one."""
    return lookup_join(lgas, shapes, ("lganame", SHAPE_NAME), {"geojson": "geojson"})


def unmatched_lga_names(lgas: DataFrame, shapes: DataFrame) -> DataFrame:
    return unmatched(lgas.select("lgacode", "lganame"), shapes, ("lganame", SHAPE_NAME))


def admin_lookup(
    lgas: DataFrame, districts: DataFrame, regions: DataFrame, include_geojson: bool = True
) -> DataFrame:
    """One row per LGA with its district and region. LGAs outside the hierarchy drop out."""
    columns = [
        F.col("r.name").alias("region_name"),
        F.col("d.districtname").alias("district_name"),
        F.col("l.lganame").alias("lga_name"),
        F.col("r.code").alias("region_code"),
        "r.school_regioncode",
        "r.household_regioncode",
        F.col("d.districtcode").alias("district_code"),
        F.col("l.lgacode").alias("lga_code"),
        "l.school_lgacode",
        "l.household_lgacode",
    ]
    if include_geojson:
        columns.append("l.geojson")
    return (
        lgas.alias("l")
        .join(districts.alias("d"), F.col("l.districtcode") == F.col("d.districtcode"))
        .join(regions.alias("r"), F.col("d.regioncode") == F.col("r.code"))
        .select(*columns)
    )


def admin_lookup_light(admin: DataFrame) -> DataFrame:
    """The lookup without shapes, for joins that need names only."""
    return admin.drop("geojson").withColumnRenamed("lga_name", "lganame")


def district_labels(df: DataFrame, admin: DataFrame, code: str = "district_code") -> DataFrame:
    """Attach region and district labels by district code."""
    return lookup_joins(df, [district_lookup(admin, code)])


def district_lookup(admin: DataFrame, code: str = "district_code") -> Lookup:
    labels = ["region_code", "region_name", "district_name"]
    return Lookup(admin, (code, "district_code"), {c: c for c in labels})
