"""Whole refreshes into tables and folders."""

import dataclasses
import datetime as dt

import pytest

from sectorloom import fixtures
from sectorloom.operators import sizing
from sectorloom.plans import lookups, refresh, water_points
from sectorloom.sources import shared
from sectorloom.sources.schemas import MissingColumns
from sectorloom.sources.stores import RAW, EmptyStage, FolderStore, TableStore, layer_of

from .conftest import SMALL, as_rows, as_set, plan

RUN = refresh.Run(fixtures.AS_OF, fixtures.YEAR, fixtures.RUN_TS, 1, 10_000)
LATER = dataclasses.replace(RUN, run_ts=fixtures.RUN_TS + dt.timedelta(days=1))
MARTS = [
    "lga_with_shape",
    "unmatched_lga_names",
    "admin_lookup",
    "admin_lookup_light",
    "school_combined",
    "qc_keys",
    "table_counts",
    "null_profile",
    "toilet_share",
    "water_share",
    "uncoded_sources",
    "no_toilet_type",
    "water_point_detail",
    "status_summary",
    "water_point_district_year",
    "districts_without_functional",
    "water_point_district_quarter",
    "coverage_district_year",
    "coverage_district_latest",
    "household_detail",
    "household_lga",
    "water_point_latest",
    "service_level_lga",
    "lga_scorecard",
    "household_lga_by_date",
]


@pytest.fixture(scope="module")
def inputs(spark):
    source = fixtures.Source(spark, SMALL)
    return {name: source[name] for name in RAW}


def contents(store, names):
    rounded = {}
    for name in names:
        df = store.read(name)
        doubles = [c for c, kind in df.dtypes if kind == "double"]
        rounded[name] = as_rows(
            df.selectExpr(*[f"round({c}, 9) AS {c}" if c in doubles else c for c in df.columns])
        )
    return rounded


def test_refresh_folders_twice_gives_the_same(spark, inputs, tmp_path):
    store = FolderStore(spark, str(tmp_path), inputs=inputs)
    refresh.refresh_all(store, RUN)
    first = contents(store, MARTS)
    assert all(first[name] for name in MARTS)
    assert store.read("qc_log").count() == 19
    flags = store.read("quality_flags").count()
    assert flags == 3
    kinds = dict(store.read("water_point_detail").dtypes)
    assert kinds["month_timestamp"] == "timestamp_ntz"
    refresh.refresh_all(store, RUN)
    assert contents(store, MARTS) == first
    assert store.read("qc_log").count() == 19
    assert store.read("quality_flags").count() == flags
    refresh.refresh_all(store, LATER)
    ids = [r["id"] for r in store.read("qc_log").select("id").collect()]
    assert len(ids) == len(set(ids)) == 38
    assert store.read("quality_flags").select("id").distinct().count() == 2 * flags


def test_refresh_tables_under_other_names(spark, inputs):
    for layer in ("t_raw", "t_marts", "t_qc"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    databases = {"raw": "t_raw", "marts": "t_marts", "quality": "t_qc"}
    store = TableStore(
        spark,
        databases,
        tables={"regions": "t_raw.all_regions", "lga_scorecard": "t_marts.card"},
        columns={"regions": {"name": "their_name"}, "lga_scorecard": {"func_rate_new": "rate"}},
    )
    for name, df in inputs.items():
        store.replace(name, df)
    assert "their_name" in spark.table("t_raw.all_regions").columns
    refresh.refresh_all(store, RUN)
    assert all(store.exists(name) for name in MARTS)
    assert "rate" in spark.table("t_marts.card").columns
    card = store.read("lga_scorecard")
    assert "func_rate_new" in card.columns and card.count() == inputs["lgas"].count()
    versions = [t.name for t in spark.catalog.listTables("t_marts") if "__v" in t.name]
    assert len(versions) == len([n for n in MARTS if layer_of(n) == "marts"])
    assert store.read("qc_log").count() == 19 and "run_id" not in store.read("qc_log").columns
    refresh.build_scorecard(store, RUN)
    assert store.read("lga_scorecard").count() == inputs["lgas"].count()


def test_missing_input_stops_with_its_name(spark, inputs, tmp_path):
    some = {k: v for k, v in inputs.items() if k != "districts"}
    store = FolderStore(spark, str(tmp_path), inputs=some)
    assert as_set(refresh.preflight(store, RAW)) == {("districts",)}
    with pytest.raises(refresh.MissingTables, match="districts") as caught:
        refresh.refresh_all(store, RUN)
    assert caught.value.names == ["districts"]
    assert store.exists("lga_with_shape") and not store.exists("admin_lookup")


def test_failed_build_leaves_a_flag_and_raises(spark, inputs, tmp_path):
    broken = {**inputs, "household_reports": inputs["household_reports"].drop("toilettypea")}
    store = FolderStore(spark, str(tmp_path), inputs=broken)
    refresh.build_shapes(store, RUN)
    with pytest.raises(Exception, match="toilettypea"):
        refresh.build_households(store, RUN)
    (flag,) = store.read("quality_flags").collect()
    assert flag["error_alert_type"] == "processing_error"
    assert flag["description"].startswith("Derived Fields Computation Error: ")
    assert flag["createdat"] == RUN.run_ts


def test_failure_while_running_leaves_a_flag_too(spark, inputs, tmp_path):
    bad = inputs["household_reports"].selectExpr(
        "* EXCEPT (toilettypea)", "raise_error('unreadable') AS toilettypea"
    )
    bad = bad.selectExpr("* EXCEPT (toilettypea)", "CAST(toilettypea AS INT) AS toilettypea")
    store = FolderStore(spark, str(tmp_path), inputs={**inputs, "household_reports": bad})
    refresh.build_shapes(store, RUN)
    with pytest.raises(Exception, match="unreadable"):
        refresh.build_households(store, RUN)
    assert store.read("quality_flags").count() == 1


def test_repeated_school_aborts(spark, inputs, tmp_path):
    services = inputs["school_services"]
    twice = services.unionAll(services.where("schoolregnumber LIKE 'EM.4%'"))
    store = FolderStore(spark, str(tmp_path), inputs={**inputs, "school_services": twice})
    refresh.build_shapes(store, RUN)
    refresh.build_admin_lookup(store, RUN)
    with pytest.raises(Exception, match="schoolregnumber is repeated"):
        refresh.build_schools(store, RUN)


def test_empty_stage_is_not_published(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    store.swap("lga_scorecard", spark.range(3))
    with pytest.raises(EmptyStage):
        store.swap("lga_scorecard", spark.range(0))
    assert store.read("lga_scorecard").count() == 3


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared.shared_dir(spark) == named
    assert shared.new_folder(spark, "x").startswith(named)
    assert shared.new_folder(spark, "x") != shared.new_folder(spark, "x")




def test_every_kind_of_processing_error(spark, inputs, tmp_path):
    reports = inputs["household_reports"]
    bad = {
        1: {"household_reports": reports.selectExpr("*", "'text' AS totalhouseholds")},
        2: {"household_reports": reports.drop("toilettypea")},
        3: {"regions": inputs["regions"].drop("household_regioncode")},
        4: {},
    }
    for kind, changed in bad.items():
        store = FolderStore(spark, str(tmp_path / str(kind)), inputs={**inputs, **changed})
        refresh.build_shapes(store, RUN)
        if kind == 4:
            save = store.replace
            store.replace = lambda name, df, *a, **k: 1 / 0 if name == "household_lga" else save(name, df, *a, **k)
        for _ in range(2):
            with pytest.raises(Exception):
                refresh.build_households(store, RUN)
        found = [r["description"] for r in store.read("quality_flags").collect() if r["error_alert_type"] == "processing_error"]
        assert len(found) == 1 and found[0].startswith(refresh.ERRORS[kind]), (kind, found)


def test_the_kind_of_error_is_that_of_the_rows_that_fail(spark, inputs, tmp_path):
    """Faults in the data, which show only while the mart is written, are filed under the part that computes them."""
    reports = inputs["household_reports"]
    largest = "* EXCEPT (toilettypea, toilettypeb), 2147483647 AS toilettypea, 2147483647 AS toilettypeb"
    unread = "* EXCEPT (toilettypea), CAST(raise_error('unreadable') AS INT) AS toilettypea"
    faults = {
        0: {"household_reports": reports.selectExpr(*_split(unread))},
        2: {"household_reports": reports.selectExpr(*_split(largest))},
        3: {"regions": inputs["regions"].selectExpr("* EXCEPT (name)", "CAST(raise_error('no name') AS STRING) AS name")},
    }
    for kind, changed in faults.items():
        store = FolderStore(spark, str(tmp_path / str(kind)), inputs={**inputs, **changed})
        refresh.build_shapes(store, RUN)
        with pytest.raises(Exception):
            refresh.build_households(store, RUN)
        (flag,) = store.read("quality_flags").collect()
        assert flag["description"].startswith(refresh.ERRORS[kind]), (kind, flag["description"][:200])
        assert not store.exists("household_detail")


def _split(text):
    first, _, rest = text.partition("), ")
    return [first + ")", *rest.split(", ")]


def test_a_failing_publish_keeps_the_old_mart(spark, tmp_path, monkeypatch):
    folder = FolderStore(spark, str(tmp_path))
    spark.sql("CREATE DATABASE IF NOT EXISTS t_swap")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_dash")
    tables = TableStore(
        spark, {"raw": "t_swap", "marts": "t_swap", "quality": "t_swap"}, tables={"lga_scorecard": "t_dash.card"}
    )
    broken = spark.range(5).selectExpr("IF(id = 4, CAST(raise_error('broken') AS BIGINT), id) AS id")
    for store in (folder, tables):
        store.swap("lga_scorecard", spark.range(3).toDF("id"))
        store.swap("lga_scorecard", spark.range(4).toDF("id"))
        assert store.read("lga_scorecard").count() == 4
        for publish in (store.swap, store.replace):
            with pytest.raises(Exception, match="broken"):
                publish("lga_scorecard", broken)
            assert store.read("lga_scorecard").count() == 4


def test_a_missing_column_is_named(spark, inputs):
    with pytest.raises(MissingColumns, match="functionalitystatus"):
        water_points.status_detail(inputs["water_point_reports"].drop("functionalitystatus"))
    upper = inputs["water_point_reports"]
    upper = upper.toDF(*[c.upper() for c in upper.columns])
    assert water_points.status_detail(upper).columns[0] == "report_datetime"


def test_thresholds_have_no_default_from_join_limits():
    with pytest.raises(TypeError):
        refresh.Run(fixtures.AS_OF, fixtures.YEAR, fixtures.RUN_TS)


def test_reports_are_spread_before_columns_are_derived(spark, inputs, tmp_path, monkeypatch):
    """What is shuffled for the partitions of the detail are columns of the reports, and that once."""
    written = []
    stage = FolderStore._stage

    def noted(self, location, df, *rest):
        written.append(plan(df, "formatted"))
        return stage(self, location, df, *rest)

    monkeypatch.setattr(FolderStore, "_stage", noted)
    store = FolderStore(spark, str(tmp_path), inputs=inputs)
    steps = [step for step in refresh.STEPS if step.name in ("shapes", "admin lookup")]
    refresh.refresh_all(store, RUN, steps)
    admin = store.read("admin_lookup")
    detail = water_points.detail_by_month(inputs["water_point_reports"], admin)
    found = store.replace("water_point_detail", detail, ["month_timestamp"], spread=True)
    assert as_rows(found.select(*detail.columns)) == as_rows(
        water_points.water_point_detail(inputs["water_point_reports"], admin)
    )
    shuffles = [part for part in written[-1].split("\n\n") if ") Exchange\n" in part and "sysid" in part]
    assert len(shuffles) == 1 and "REBALANCE_PARTITIONS_BY_COL" in shuffles[0]
    for derived in ("wp_functional", "quarter_timestamp", "region_name", "meternumber"):
        assert derived not in shuffles[0]


def test_large_labels_are_joined_before_the_detail_is_spread(spark, inputs, monkeypatch):
    reports, admin = inputs["water_point_reports"].limit(200), _admin(inputs)
    wanted = as_rows(water_points.water_point_detail(reports, admin))
    monkeypatch.setattr(sizing, "MAX_ROWS", 1)
    detail = water_points.detail_by_month(reports, _admin(inputs))
    assert as_rows(detail) == wanted
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(detail).split("SortMergeJoin")[0]


def _admin(inputs):
    shaped = lookups.lgas_with_shape(inputs["lgas"], inputs["lga_shapes"])
    return lookups.admin_lookup(shaped, inputs["districts"], inputs["regions"])


def test_reports_are_not_shuffled_to_find_their_supplier(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = fixtures.Source(spark, SMALL)
        for name in ("water_point_reports", "household_reports", "coverage_reports"):
            assert "SortMergeJoin" not in plan(source[name]), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
