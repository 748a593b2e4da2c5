"""The raw inputs, emulated from TPC-H-like tables.

The expressions are valid in Spark SQL and in DuckDB, so the oracle states its inputs with the same text.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.sizing import MAX_BYTES, measure

AS_OF = dt.date(2001, 8, 15)
YEAR = 2024
RUN_TS = dt.datetime(2024, 7, 1)


@dataclass(frozen=True)
class Emulated:
    tables: tuple[str, ...]
    columns: dict[str, str]
    joins: tuple[str, ...] = ()
    where: str | None = None

    def sql(self) -> str:
        columns = ", ".join(f"{text} AS {name}" for name, text in self.columns.items())
        query = f"SELECT {columns} FROM {self.tables[0]}"
        for table, condition in zip(self.tables[1:], self.joins):
            query += f" JOIN {table} ON {condition}"
        return query + (f" WHERE {self.where}" if self.where else "")


SCHOOL = (
    "CASE p_partkey % 4 WHEN 0 THEN 'EM.' WHEN 1 THEN 'ES.' WHEN 2 THEN 'S.' ELSE 'X.' END"
    " || CAST(p_partkey AS STRING)"
)
SUPPLIER_NATION = ("l_suppkey = s_suppkey", "s_nationkey = n_nationkey")


def _report_date(every: int) -> str:
    return f"CASE WHEN p_partkey % {every} = 0 THEN DATE '2023-06-30' ELSE DATE '2024-06-30' END"


def _flag(modulus: int, unknown: int, test: str) -> str:
    return f"CASE WHEN p_size % {modulus} = {unknown} THEN NULL ELSE p_size % {modulus} {test} END"


def _toilet(column: str) -> str:
    return f"CASE WHEN l_orderkey % 19 = 0 THEN 0 ELSE {column} END"


def _holes(modulus: int) -> str:
    return (
        f"CASE WHEN p_size % {modulus} = 0 THEN 0 WHEN p_size % {modulus} = 1 THEN NULL"
        " ELSE p_size END"
    )


INPUTS: dict[str, Emulated] = {
    "regions": Emulated(
        ("region",),
        {
            "code": "'R' || CAST(r_regionkey AS STRING)",
            "name": "r_name",
            "school_regioncode": "'BR' || CAST(r_regionkey AS STRING)",
            "household_regioncode": (
                "CASE WHEN r_regionkey = 4 THEN 'NRX'"
                " ELSE 'NR' || CAST(r_regionkey AS STRING) END"
            ),
        },
    ),
    "districts": Emulated(
        ("nation",),
        {
            "districtcode": "'D' || CAST(n_nationkey AS STRING)",
            "districtname": "n_name",
            "regioncode": "'R' || CAST(n_regionkey AS STRING)",
        },
    ),
    "lgas": Emulated(
        ("supplier",),
        {
            "lgacode": "'L' || CAST(s_suppkey AS STRING)",
            "lganame": "s_name",
            "districtcode": "'D' || CAST(s_nationkey AS STRING)",
            "school_lgacode": "'BL' || CAST(s_suppkey AS STRING)",
            "household_lgacode": (
                "CASE WHEN s_suppkey % 10 = 7 THEN 'NLX' ELSE 'NL' END"
                " || CAST(s_suppkey AS STRING)"
            ),
        },
    ),
    "lga_shapes": Emulated(
        ("supplier",),
        {
            "Authority": "s_name",
            "geojson": (
                "'{\"type\":\"Point\",\"coordinates\":[' || CAST(30 + s_suppkey % 10 AS STRING)"
                " || ',' || CAST(-1 - s_suppkey % 10 AS STRING) || ']}'"
            ),
        },
        where="s_suppkey % 10 <> 3",
    ),
    "water_point_reports": Emulated(
        ("lineitem", "supplier", "nation"),
        {
            "sysid": (
                "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'"
                " || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-'"
                " || CAST(CAST(FLOOR(l_extendedprice) AS INT) AS STRING)"
            ),
            "report_datetime": "l_shipdate",
            "report_year": "CAST(EXTRACT(YEAR FROM l_shipdate) AS STRING)",
            "region": "'R' || CAST(n_regionkey AS STRING)",
            "district": (
                "CASE WHEN l_partkey % 97 = 0 THEN 'DX'"
                " ELSE 'D' || CAST(s_nationkey AS STRING) END"
            ),
            "lga": "'L' || CAST(l_suppkey AS STRING)",
            "village": "'V' || CAST(l_partkey AS STRING)",
            "ward": "'W' || CAST(l_partkey % 50 AS STRING)",
            "dpid": "'DP' || CAST(l_partkey AS STRING)",
            "populationserved": "CAST(l_quantity AS INT)",
            "latitude": (
                "CASE WHEN l_orderkey % 11 = 0 THEN NULL"
                " ELSE CAST(-1 - l_partkey % 10 AS DOUBLE) END"
            ),
            "longitude": (
                "CASE WHEN l_orderkey % 13 = 0 THEN NULL"
                " ELSE CAST(30 + l_partkey % 10 AS DOUBLE) END"
            ),
            "functionalitystatus": (
                "CASE WHEN s_nationkey IN (7, 8) AND l_shipdate < DATE '1996-01-01' THEN 'on_construction'"
                " WHEN l_linenumber = 1 THEN 'functional' WHEN l_linenumber = 2 THEN 'functional_need_repair'"
                " WHEN l_linenumber = 3 THEN 'not_functional' WHEN l_linenumber = 4 THEN 'abandoned'"
                " WHEN l_linenumber = 5 THEN 'archived' WHEN l_linenumber = 6 THEN 'on_construction' END"
            ),
        },
        SUPPLIER_NATION,
    ),
    "coverage_reports": Emulated(
        ("orders", "customer"),
        {
            "district": "'D' || CAST(c_nationkey AS STRING)",
            "report_datetime": "o_orderdate",
            "infracoverage": "CASE WHEN o_orderkey % 13 = 0 THEN 0.0E0 ELSE o_totalprice / 5000 END",
        },
        ("o_custkey = c_custkey",),
    ),
    "villages": Emulated(
        ("customer",),
        {
            "villagecode": "'V' || CAST(c_custkey AS STRING)",
            "villagename": "c_name",
            "lgacode": "'L' || CAST(c_custkey % 10 AS STRING)",
            "infracoverage": "50 + c_acctbal / 250",
            "status": "CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END",
            "isvillage": "c_custkey % 7 <> 0",
            "servicetype": (
                "CASE c_custkey % 4 WHEN 0 THEN 'no_service' WHEN 1 THEN NULL"
                " ELSE c_mktsegment END"
            ),
            "servedbyagency": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 3 <> 0 END",
        },
    ),
    "household_reports": Emulated(
        ("lineitem", "supplier", "nation"),
        {
            "regioncode": "'NR' || CAST(n_regionkey AS STRING)",
            "lgacode": "'NL' || CAST(l_suppkey AS STRING)",
            "reportdate": "CAST(date_trunc('quarter', l_shipdate) AS DATE)",
            "createdat": "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_shipdate END",
            "toilettypea": (
                "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_orderkey % 19 = 0 THEN 0"
                " ELSE CAST(l_quantity AS INT) END"
            ),
            "toilettypeb": _toilet("l_linenumber"),
            "toilettypec": "CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(l_partkey % 7 AS INT) END",
            "toilettyped": _toilet("CAST(l_partkey % 5 AS INT)"),
            "toilettypee": _toilet("CAST(l_partkey % 3 AS INT)"),
            "toilettypef": "CAST(NULL AS INT)",
            "toilettypex": _toilet("CAST(l_orderkey % 4 AS INT)"),
            "handwashingstation": (
                "CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE CAST(l_partkey % 60 AS INT) END"
            ),
            "hwfsoapwater": "CAST(l_partkey % 30 AS INT)",
        },
        SUPPLIER_NATION,
    ),
    "school_services": Emulated(
        ("part",),
        {
            "schoolregnumber": SCHOOL,
            "reportdate": _report_date(9),
            "haselectricity": "p_size > 10",
            "handwashingfacilities": "p_size",
            "handwashingtype": "p_size % 2 = 0",
            "watersource": (
                "CASE p_size % 8 WHEN 0 THEN 'Maji ya BOMBA' WHEN 1 THEN 'maji ya mvua'"
                " WHEN 2 THEN 'visima vifupi' WHEN 3 THEN 'Maji ya Mto' WHEN 4 THEN 'bwawa'"
                " WHEN 5 THEN 'chemchem' WHEN 6 THEN 'other' ELSE NULL END"
            ),
            "electricitysource": "p_brand",
            "sanitarypadsprovided": "p_size % 3 = 0",
            "menstrualcounselor": "p_size % 5 = 0",
            "capitationgrant": "p_retailprice",
            "signedsitebook": "p_size % 7 = 0",
            "completioncertificate": "p_size % 11 = 0",
        },
    ),
    "school_reports": Emulated(
        ("part",),
        {
            "schoolregnumber": SCHOOL,
            "regioncode": "'BR' || CAST(p_partkey % 5 AS STRING)",
            "lgacode": (
                "CASE WHEN p_partkey % 29 = 0 THEN 'BLX'"
                " ELSE 'BL' || CAST(p_partkey % 10 AS STRING) END"
            ),
            "gpscoordinates": "CAST(p_partkey % 10 AS STRING) || ',30'",
            "schoolpforrprogram": "p_partkey % 2 = 0",
        },
        where="p_partkey % 11 <> 5",
    ),
    "school_infrastructure": Emulated(
        ("part",),
        {
            "schoolregnumber": SCHOOL,
            "reportdate": _report_date(10),
            "classroomcount": _holes(12),
            "classroomsrequired": _holes(14),
            "dispensaries": "p_size % 2",
            "dropholesboys": _holes(10),
            "dropholesgirls": _holes(9),
            "dropholesspecialneedsboys": (
                "CASE WHEN p_size % 4 = 0 THEN 0 WHEN p_size % 4 = 1 THEN NULL ELSE 1 END"
            ),
            "dropholesspecialneedsgirls": "CASE WHEN p_size % 6 = 0 THEN 1 ELSE 0 END",
            "dropholesmaleteachers": "CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 3 END",
            "dropholesfemaleteachers": "CASE WHEN p_size % 8 = 0 THEN NULL ELSE p_size % 5 END",
            "latrineslockable": _flag(3, 0, "= 1"),
            "latrinesmaintained": _flag(5, 0, "= 1"),
            "latrineshavewashablefloor": _flag(7, 0, "= 1"),
            "latrineswithoutwastewaterdischarge": _flag(9, 0, "= 1"),
            "latrinesconnectedstspcesspit": _flag(11, 0, "= 1"),
            "responsibleforcleanlinesstoiletsboys": (
                "CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'pupils' END"
            ),
            "responsibleforcleanlinesstoiletsgirls": (
                "CASE WHEN p_size % 6 = 0 THEN NULL ELSE 'staff' END"
            ),
            "toilettypeftconnmainsewerline": _flag(8, 7, "= 0"),
            "toilettypeftconnseptictank": _flag(8, 7, "= 1"),
            "toilettypeftconnpit": _flag(8, 7, "= 2"),
            "toilettypevippitlatrine": _flag(8, 7, "= 3"),
            "toilettypeftconnanotherloc": _flag(8, 7, "= 4"),
            "toilettypepitlatrinewithfloor": _flag(8, 7, "IN (2, 5)"),
            "toilettypeopenpitlatrine": "CAST(NULL AS BOOLEAN)",
            "toilettypeothers": "CASE WHEN p_size % 8 = 7 THEN NULL ELSE FALSE END",
            "burningchambers": _holes(15),
            "septictanks": _holes(16),
            "watertanks": _holes(17),
            "specialgirlsroom": _flag(6, 0, "= 1"),
        },
        where="p_partkey % 13 <> 6",
    ),
    "school_enrollment": Emulated(
        ("part",),
        {
            "schoolregnumber": SCHOOL,
            "totalgirls": "CAST((p_partkey * 37) % 1000 AS STRING)",
            "totalboys": "CAST((p_partkey * 53) % 1000 AS STRING)",
            "totalpupils": (
                "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST((p_partkey * 37) % 1000"
                " + (p_partkey * 53) % 1000 + CASE WHEN p_partkey % 31 = 0 THEN 5 ELSE 0 END"
                " AS STRING) END"
            ),
        },
        where="p_partkey % 17 <> 8",
    ),
    # Enrollment as it comes in, with counts that are no numbers.
    "dirty_enrollment": Emulated(
        ("part",),
        {
            "schoolregnumber": SCHOOL,
            "totalgirls": "CASE WHEN p_partkey % 29 = 0 THEN 'n/a' ELSE CAST(p_size AS STRING) END",
            "totalboys": (
                "CASE WHEN p_partkey % 31 = 0 THEN '1 200' WHEN p_partkey % 37 = 0 THEN NULL"
                " ELSE ' ' || CAST(p_size AS STRING) || ' ' END"
            ),
            "totalpupils": (
                "CASE WHEN p_partkey % 29 = 0 THEN '' WHEN p_partkey % 41 = 0 THEN CAST(p_size AS STRING) || 'x'"
                " ELSE CAST(p_size AS STRING) || '.0' END"
            ),
        },
        where="p_partkey % 17 <> 8",
    ),
    "water_data": Emulated(
        ("events",),
        {"date_recorded": "ts", "region": "event_type", "functioning_percentage": "value"},
    ),
    "source_data": Emulated(
        ("events",),
        {
            "recorded_date": "ts + INTERVAL '1' DAY * CAST(event_id % 400 AS INT)",
            "metric": "CASE WHEN event_id % 7 = 3 THEN NULL ELSE value END",
        },
    ),
    "lga_boundaries": Emulated(
        ("supplier",),
        {
            "id": "s_suppkey",
            "name": "CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE s_name END",
            "wkt": (
                "CASE s_suppkey % 10"
                " WHEN 0 THEN 'POINT (' || CAST(s_suppkey AS STRING) || ' -7.25)'"
                " WHEN 1 THEN 'LINESTRING(0 0, ' || CAST(s_suppkey AS STRING) || ' 1.5, 4 0)'"
                " WHEN 2 THEN 'POLYGON((0 0, 0 ' || CAST(s_suppkey AS STRING) || ', 4 4, 4 0, 0 0))'"
                " WHEN 3 THEN 'polygon ((0 0, 4 0, 4 4, 0 ' || CAST(s_suppkey AS STRING) || ', 0 0))'"
                " WHEN 4 THEN 'POLYGON((0 0,9 0,9 9,0 9,0 0),(1 1,2 1,2 2,1 2,1 1))'"
                " WHEN 5 THEN 'MULTIPOLYGON(((0 0,0 1,1 1,0 0)),((5 5,6 5,6 6,5 5)))'"
                " WHEN 6 THEN NULL"
                " WHEN 7 THEN 'POLYGON((0 0, 1 1'"
                " WHEN 8 THEN 'MULTIPOINT((1 2),(3 ' || CAST(s_suppkey AS STRING) || '))'"
                " ELSE 'MULTILINESTRING((0 0,1 1),(2 2,3 ' || CAST(s_suppkey AS STRING) || '))' END"
            ),
        },
    ),
}


class Source:
    """The emulated inputs over the Parquet tables of one folder; each file is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self._emulate(INPUTS[name], self.table(INPUTS[name].tables[0]))

    def stream(self, name: str) -> DataFrame:
        """The input with its first table read as a stream of files."""
        first = INPUTS[name].tables[0]
        # A glob, because a stream takes a plain path for a folder.
        path = f"{self.sf_dir}/{first[:-1]}[{first[-1]}].parquet"
        files = self.spark.readStream.schema(self.table(first).schema).parquet(path)
        return self._emulate(INPUTS[name], files)

    def _emulate(self, made: Emulated, df: DataFrame) -> DataFrame:
        for table, condition in zip(made.tables[1:], made.joins):
            df = df.join(self._joined(table, made), F.expr(condition))
        if made.where:
            df = df.where(made.where)
        return df.selectExpr(*[f"{text} AS {column}" for column, text in made.columns.items()])

    def _joined(self, name: str, made: Emulated) -> DataFrame:
        """The columns of a joined table that the input uses; broadcast if their true bytes allow it.

        They are few and narrow, while Spark goes by the size of whole files and would shuffle all reports.
        """
        used = set(re.findall(r"\w+", made.sql()))
        table = self.table(name)
        columns = [c for c in table.columns if c in used]
        small = measure(table, columns).bytes <= MAX_BYTES
        return F.broadcast(table.select(*columns)) if small else table
