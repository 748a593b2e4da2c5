"""Every registered query equals its DuckDB SQL on whole tables."""

import pytest

import __spark_entry__ as entry
import check_oracle
import oracle_queries
from sectorloom import fixtures
from sectorloom.plans import water_points

from .conftest import SMALL, plan

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.oracle(SMALL)


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) <= set(entry.queries())
    assert set(entry.QUERIES) == set(oracle_queries.oracle_sql())


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_equal_and_planned_without_pairs_or_python(spark, connection, name):
    df = entry.queries()[name](spark, SMALL)
    text = plan(df)
    for operator in FORBIDDEN:
        assert operator not in text
    assert check_oracle.compare(df, connection, name) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "func_rate_new" in df.columns


def test_large_aggregates_combine_on_the_map_side(spark):
    for name in ("wp_district_year", "hh_lga_by_date", "hh_lga_mean", "service_level_lga"):
        text = plan(entry.queries()[name](spark, SMALL))
        assert "partial_sum" in text or "partial_avg" in text


def test_window_of_the_latest_reports_reaches_the_scan(spark):
    text = plan(entry.queries()["wp_latest_located"](spark, SMALL), "formatted")
    (pushed,) = [line for line in text.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert "GreaterThanOrEqual(l_shipdate,2001-05-01T00:00)" in pushed
    assert "LessThan(l_shipdate,2001-08-01T00:00)" in pushed


def test_unused_columns_are_not_read(spark):
    df = fixtures.Source(spark, SMALL)["water_point_reports"]
    shares = water_points.status_share(water_points.status_detail(df))
    read = [line for line in plan(shares, "formatted").splitlines() if "l_linenumber" in line]
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int>" in [x.strip() for x in read]
