"""Rows with WKT text to GeoJSON Features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo


def split_features(
    df: DataFrame, wkt_col: str, out_col: str = "geojson", srid: int = geo.DEFAULT_SRID
) -> tuple[DataFrame, DataFrame]:
    """(rows with a Feature in ``out_col``, rows whose text is not a readable geometry).

    The Feature holds all other columns as properties, NULL ones included. A NULL text gives a Feature
    without geometry.
    """
    if wkt_col not in df.columns:
        raise ValueError(f'column "{wkt_col}" does not exist')
    parsed = _parsed(df, wkt_col)
    failed = F.col(wkt_col).isNotNull() & ~F.col("__valid")
    properties = [c for c in df.columns if c not in (wkt_col, out_col)]
    kept = [c for c in df.columns if c != out_col]
    rings = geo.orient(F.col("__kind"), F.col("__rings"))
    coordinates = F.when(F.col("__empty"), F.lit("[]")).otherwise(
        geo.coordinates_text(F.col("__kind"), rings)
    )
    geometry = geo.geometry_text(F.col("__kind"), coordinates, srid)
    members = F.to_json(F.struct(*[F.col(f"`{c}`") for c in properties]), {"ignoreNullFields": "false"})
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'),
        members if properties else F.lit("{}"),
        F.lit(',"geometry":'),
        F.coalesce(F.when(F.col(wkt_col).isNotNull(), geometry), F.lit("null")),
        F.lit("}"),
    )
    features = parsed.where(~failed).select(*kept, feature.alias(out_col))
    return features, parsed.where(failed).select(*kept)


def to_feature(
    df: DataFrame, wkt_col: str, out_col: str = "geojson", srid: int = geo.DEFAULT_SRID
) -> DataFrame:
    return split_features(df, wkt_col, out_col, srid)[0]


def _parsed(df: DataFrame, wkt_col: str) -> DataFrame:
    wkt, kind, body, rings = (F.col(c) for c in (wkt_col, "__kind", "__body", "__rings"))
    typed = _bind(
        df, __kind=geo.geometry_type(wkt), __body=geo.wkt_body(wkt), __empty=geo.is_empty(wkt)
    )
    ringed = _bind(typed, __rings=geo.parse_rings(kind, body))
    readable = geo.is_valid(kind, body, rings)
    valid = (kind != "") & (F.col("__empty") | F.coalesce(readable, F.lit(False)))
    return _bind(ringed, __valid=F.coalesce(valid, F.lit(False)))


def _bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A plain projection would be merged into every later use, and the parsed rings of a large shape would
    be parsed again for each of its points. The optimizer does not merge across a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
