"""School checks against brute force, with repeated, missing and NULL numbers."""

import datetime as dt
from collections import Counter

import pytest

from sectorloom.plans import school_quality as quality
from sectorloom.plans import schools
from sectorloom.sources.schemas import SCHOOL_COMBINED, SCHOOL_FACILITIES, conform, names, run_number

from .conftest import as_rows, as_set, padded, plan

RUN = dt.datetime(2024, 7, 1)
IN, OUT = dt.date(2024, 5, 1), dt.date(2023, 5, 1)
SERVICES = [("a", IN), ("b", IN), ("c", OUT), ("d", IN), (None, IN), ("e", IN)]
REPORTS = ["a", "a", "c", "x", "x", "y", None]
INFRASTRUCTURE = ["a", "b", "b", "z", "z", "z", None]
COMBINED = ["a", "b", "d", "e"]


@pytest.fixture
def presence(spark):
    def keys(values):
        return spark.createDataFrame([(v,) for v in values], "schoolregnumber string")

    services = spark.createDataFrame(SERVICES, "schoolregnumber string, reportdate date")
    return quality.key_presence(
        services, keys(REPORTS), keys(INFRASTRUCTURE), keys(COMBINED), 2024
    )


@pytest.fixture
def combined(spark):
    rows = [
        ("a", "Primary/Pre-Primary", "well", 1, 1, 10.0, 20.0, 30.0, True, True, 1, "R", "L"),
        ("b", "Secondary", None, None, 0, 800.0, 700.0, 1500.0, False, None, 0, "R", None),
        ("d", "Secondary", "lake", 0, None, 5.0, 5.0, 11.0, False, False, None, None, None),
        ("e", "Secondary", "lake", 0, None, None, 5.0, 11.0, False, True, None, "R", "L"),
    ]
    df = spark.createDataFrame(
        rows,
        "schoolregnumber string, school_category string, watersource string,"
        " improved_water_source int, improved_toilet_type int, boy_pupils double,"
        " girl_pupils double, total_pupils double, meet_drophole_ratio boolean,"
        " separate_latrines_teachers boolean, improved_sanitation_school int,"
        " region_name string, lga_name string",
    )
    return conform(df, SCHOOL_COMBINED, names(SCHOOL_COMBINED))


def brute_force_lists():
    in_year = [k for k, day in SERVICES if day == IN]
    all_services = {k for k, _ in SERVICES if k}
    return {
        "unmatched_services_not_in_reports": [k for k in in_year if k not in set(REPORTS) - {None}],
        "unmatched_reports_not_in_services": [k for k in REPORTS if k not in all_services],
        "infra_not_in_combined": [k for k in INFRASTRUCTURE if k not in COMBINED],
        "combined_not_in_infra": [k for k in COMBINED if k not in INFRASTRUCTURE],
        "missing_region_lga_names": ["b", "d"],
        "enrollment_mismatches": ["d"],
    }


def test_log(presence, combined):
    log = quality.qc_log(presence, combined, RUN).collect()
    first = run_number(RUN)
    assert [r["id"] for r in sorted(log, key=lambda r: r["id"])] == [first + i for i in range(1, 20)]
    found = {r["check_name"]: (r["result_value"], r["details"]) for r in log}
    for name, listed in brute_force_lists().items():
        assert found[name] == (str(len(listed)), quality.KEY_TABLE), name
    assert set(brute_force_lists()) == set(quality.LISTED)
    assert found["unique_schools_services"] == ("4", None)
    assert found["unique_schools_reports"] == ("4", None)
    assert found["matched_services_reports"] == ("1", None)
    assert found["unique_schools_infrastructure"] == ("3", None)
    assert found["matched_combined_infrastructure"] == ("2", None)
    assert found["school_category_counts"] == (None, "Primary/Pre-Primary:1, Secondary:3")
    assert found["null_watersource_count"] == ("1", None)
    assert found["null_improved_toilet_type"] == ("2", None)
    assert found["enrollment_totals"] == (None, "boys:815, girls:730, total:1552")
    assert found["enrollment_over_under_1500"] == (None, "over_1500:1, under_1500:3")
    assert found["meet_drophole_ratio_count"] == ("1", None)
    assert found["separate_latrines_teachers_count"] == ("2", None)
    assert found["percent_improved_sanitation"] == ("25.0", None)


def test_keys_are_whole(presence, combined):
    keys = quality.failing_keys(presence, combined)
    expected = {
        (name, key, n)
        for name, listed in brute_force_lists().items()
        for key, n in Counter(listed).items()
    }
    assert as_set(keys) == expected


def test_log_is_the_same_shape_for_thousands_of_failing_schools(spark, presence, combined):
    many = spark.range(2500).selectExpr(
        "'EM.' || id AS schoolregnumber",
        *[f"{1 if c == 'combined' else 0}L AS {c}" for c in presence.columns[1:]],
    )
    log = quality.qc_log(presence.unionByName(many), combined, RUN).collect()
    (row,) = [r for r in log if r["check_name"] == "combined_not_in_infra"]
    listed = brute_force_lists()["combined_not_in_infra"]
    assert (row["result_value"], row["details"]) == (str(2500 + len(listed)), quality.KEY_TABLE)
    keys = quality.failing_keys(presence.unionByName(many), combined)
    assert keys.where("check_name = 'combined_not_in_infra' AND schoolregnumber LIKE 'EM.%'").count() >= 2500


def test_log_reads_its_inputs_once(presence, combined):
    text = plan(quality.qc_log(presence, combined, RUN))
    assert "BroadcastExchange" not in text and "Join" not in text


def test_empty_mart(presence, combined):
    none = combined.where("false")
    log = quality.qc_log(presence, none, RUN)
    found = {r["check_name"]: (r["result_value"], r["details"]) for r in log.collect()}
    assert len(found) == 19
    assert found["null_watersource_count"] == ("0", None)
    assert found["enrollment_totals"] == (None, "boys:0, girls:0, total:0")
    assert found["enrollment_over_under_1500"] == (None, None)
    assert found["percent_improved_sanitation"] == (None, None)
    assert found["school_category_counts"] == (None, None)


def test_shares(combined):
    assert as_set(quality.toilet_share(combined)) == {(None, 2, 50.0), (1, 1, 25.0), (0, 1, 25.0)}
    assert as_set(quality.water_share(combined)) == {(0, 2, 50.0), (1, 1, 25.0), (None, 1, 25.0)}
    assert as_set(quality.uncoded_sources(combined)) == {(None, 1, 100.0)}
    counts = [r["count"] for r in quality.toilet_share(combined).collect()]
    assert counts == sorted(counts, reverse=True)


def test_no_toilet_type(spark, combined):
    assert quality.no_toilet_type(combined).count() == 4
    known = combined.selectExpr("* EXCEPT (toilettypeothers)", "false AS toilettypeothers")
    assert quality.no_toilet_type(known).count() == 0


def test_table_counts_and_null_profile(spark):
    a = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "schoolregnumber string, watertanks int")
    b = spark.createDataFrame([(k,) for k in "abcd"], "schoolregnumber string")
    counts = quality.table_counts({"a": a, "b": b, "none": b.where("false")}, 1, 3)
    assert as_rows(counts) == [("a", 3, 1, "ok"), ("b", 4, 4, "high"), ("none", 0, 0, "low")]
    profile = {r["field"]: tuple(r)[1:] for r in quality.null_profile(padded(a, SCHOOL_FACILITIES), {"a": a, "b": b}).collect()}
    assert len(profile) == 28
    assert profile["watertanks"] == (1, 4, 25.0)
    assert profile["classroomcount"] == (3, 4, 75.0)


def test_unreadable_counts_are_kept_and_counted(spark):
    rows = [("A", "12", "x", None), ("A", "1e2", "", " 7 "), (None, "--", "3", "4"), ("B", "5", "6", "1,000")]
    df = spark.createDataFrame(rows, "schoolregnumber string, totalgirls string, totalboys string, totalpupils string")
    rejects = schools.rejected_counts(df)
    assert {(r["schoolregnumber"], r["column_name"], r["value"]) for r in rejects.collect()} == {
        ("A", "totalboys", "x"), ("A", "totalboys", ""), (None, "totalgirls", "--"), ("B", "totalpupils", "1,000"),
    }
    counts = {r["column_name"]: (r["row_count"], r["school_count"]) for r in schools.reject_counts(rejects).collect()}
    assert counts == {"totalboys": (2, 1), "totalgirls": (1, 0), "totalpupils": (1, 1)}
    assert schools.rejected_counts(df.where("false")).collect() == []
    assert "Exchange" not in plan(rejects)
    numbers = df.selectExpr("schoolregnumber", *[f"try_cast({c} AS INT) AS {c}" for c in schools.COUNTS])
    assert schools.rejected_counts(numbers).collect() == []
