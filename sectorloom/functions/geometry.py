"""WKT text to GeoJSON text with native expressions.

Every geometry is parsed into one shape, a list of polygons of rings of points, whatever its type; the
type decides how rings are turned and how many outer levels are written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# GeoJSON names by upper-case WKT type.
GEOJSON_TYPES = {
    "POINT": "Point",
    "LINESTRING": "LineString",
    "POLYGON": "Polygon",
    "MULTIPOINT": "MultiPoint",
    "MULTILINESTRING": "MultiLineString",
    "MULTIPOLYGON": "MultiPolygon",
}
# Bracket outline after collapsing rings to R and polygons to P.
OUTLINES = {
    "POINT": ("R",),
    "LINESTRING": ("R",),
    "POLYGON": ("(R)",),
    "MULTIPOINT": ("R", "(R)"),
    "MULTILINESTRING": ("(R)",),
    "MULTIPOLYGON": ("(P)",),
}
MAX_DIGITS = 9
DEFAULT_SRID = 4326


def geometry_type(wkt: Column) -> Column:
    """Upper-case type name; empty when the text does not start with a known one."""
    return F.upper(F.regexp_extract(wkt, rf"(?i)^\s*({'|'.join(GEOJSON_TYPES)})\s*(Z\s*)?(\(|EMPTY)", 1))


def wkt_body(wkt: Column) -> Column:
    """The bracketed part without spaces around brackets and commas."""
    body = F.regexp_extract(wkt, r"(?s)^[^(]*(\(.*\))\s*$", 1)
    return F.regexp_replace(F.regexp_replace(body, r"\s*([(),])\s*", "$1"), r"\s+", " ")


def is_empty(wkt: Column) -> Column:
    return F.coalesce(wkt.rlike(r"(?i)^\s*[A-Z]+\s*(Z\s*)?EMPTY\s*$"), F.lit(False))


def parse_rings(kind: Column, body: Column) -> Column:
    """``array<array<array<array<double>>>>``: polygons, rings, points, numbers (NULL if unreadable)."""
    polygons = F.when(kind == "MULTIPOLYGON", F.split(body, r"\)\),\(\(")).otherwise(F.array(body))

    def rings(text: Column) -> Column:
        nested = kind.isin("POLYGON", "MULTIPOLYGON", "MULTILINESTRING")
        return F.when(nested, F.split(text, r"\),\(")).otherwise(F.array(text))

    def points(text: Column) -> Column:
        return F.split(F.translate(text, "()", ""), ",")

    def numbers(text: Column) -> Column:
        return F.transform(F.split(text, " "), lambda n: F.round(n.try_cast("double"), MAX_DIGITS))

    return F.transform(
        polygons, lambda p: F.transform(rings(p), lambda r: F.transform(points(r), numbers))
    )


def outline(body: Column) -> Column:
    """Brackets only, with each ring as R and each polygon of rings as P where it is repeated."""
    brackets = F.regexp_replace(body, r"[^(),]+", "")
    rings = F.replace(F.regexp_replace(brackets, r"\(,*\)", "R"), F.lit(",R"), F.lit(""))
    polygons = F.replace(F.replace(rings, F.lit("(R)"), F.lit("P")), F.lit(",P"), F.lit(""))
    return F.when(polygons == "P", F.lit("(R)")).otherwise(polygons)


def is_valid(kind: Column, body: Column, rings: Column) -> Column:
    """Well-formed brackets, readable points of 2 or 3 numbers, and closed, long enough rings."""
    shape = F.lit(False)
    for name, allowed in OUTLINES.items():
        shape = shape | ((kind == name) & outline(body).isin(*allowed))
    stray = body.rlike(r"\)[^,)]|[^,(]\(")
    size = F.size(F.element_at(F.element_at(F.element_at(rings, 1), 1), 1))

    def point_ok(point: Column) -> Column:
        return F.size(point).isin(2, 3) & (F.size(point) == size) & F.forall(point, _is_finite)

    def ring_ok(ring: Column) -> Column:
        closed = F.element_at(ring, 1) == F.element_at(ring, -1)
        long_enough = (
            F.when(kind.isin("POLYGON", "MULTIPOLYGON"), (F.size(ring) >= 4) & closed)
            .when(kind.isin("LINESTRING", "MULTILINESTRING"), F.size(ring) >= 2)
            .when(kind == "POINT", F.size(ring) == 1)
            .otherwise(F.lit(True))
        )
        return F.forall(ring, point_ok) & long_enough

    return shape & ~stray & F.forall(rings, lambda polygon: F.forall(polygon, ring_ok))


def _is_finite(number: Column) -> Column:
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))


def signed_area(ring: Column) -> Column:
    """Twice the enclosed area, above zero for a counter-clockwise ring."""

    def x(i: Column) -> Column:
        return F.get(F.get(ring, i), F.lit(0)) - F.get(F.get(ring, F.lit(0)), F.lit(0))

    def y(i: Column) -> Column:
        return F.get(F.get(ring, i), F.lit(1))

    steps = F.sequence(F.lit(0), F.size(ring) - 2)
    return F.aggregate(steps, F.lit(0.0), lambda sum_, i: sum_ + x(i) * y(i + 1) - x(i + 1) * y(i))


def orient(kind: Column, rings: Column) -> Column:
    """Outer rings counter-clockwise, holes clockwise, lines reversed, points as they are."""

    def turned(ring: Column, i: Column) -> Column:
        counter_clockwise = signed_area(ring) >= 0
        return F.when(counter_clockwise == (i == 0), ring).otherwise(F.reverse(ring))

    return (
        F.when(
            kind.isin("POLYGON", "MULTIPOLYGON"),
            F.transform(rings, lambda polygon: F.transform(polygon, turned)),
        )
        .when(
            kind.isin("LINESTRING", "MULTILINESTRING"),
            F.transform(rings, lambda lines: F.transform(lines, F.reverse)),
        )
        .otherwise(rings)
    )


def _number_text(number: Column) -> Column:
    """Plain decimal digits without trailing zeros; at most :data:`MAX_DIGITS` after the point."""
    plain = F.call_function("format_number", number, F.lit("0." + "#" * MAX_DIGITS))
    return F.when(number == 0, F.lit("0")).otherwise(plain)


def _json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def coordinates_text(kind: Column, rings: Column) -> Column:
    def point(p: Column) -> Column:
        return _json_list(F.transform(p, _number_text))

    def ring(r: Column) -> Column:
        return _json_list(F.transform(r, point))

    def polygon(p: Column) -> Column:
        return _json_list(F.transform(p, ring))

    first = F.get(rings, F.lit(0))
    return (
        F.when(kind == "POINT", point(F.get(F.get(first, F.lit(0)), F.lit(0))))
        .when(kind.isin("LINESTRING", "MULTIPOINT"), ring(F.get(first, F.lit(0))))
        .when(kind.isin("POLYGON", "MULTILINESTRING"), polygon(first))
        .otherwise(_json_list(F.transform(rings, polygon)))
    )


def geometry_text(kind: Column, coordinates: Column, srid: int = DEFAULT_SRID) -> Column:
    """GeoJSON geometry; another reference system than the default is named in a ``crs`` member."""
    names = F.create_map(*[F.lit(text) for pair in GEOJSON_TYPES.items() for text in pair])
    crs = ""
    if srid not in (0, DEFAULT_SRID):
        crs = f'"crs":{{"type":"name","properties":{{"name":"EPSG:{srid}"}}}},'
    return F.concat(
        F.lit('{"type":"'), names[kind], F.lit(f'",{crs}"coordinates":'), coordinates, F.lit("}")
    )
