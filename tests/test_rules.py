"""Business rules on hand-written rows, NULL cases included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sectorloom.functions import indicators as ind
from sectorloom.functions import periods, ratios
from sectorloom.plans import coverage, households, schools, scorecard, water_points
from sectorloom.sources.schemas import (
    run_number,
    SCHOOL_FACILITIES,
    SCHOOL_REPORT,
    SCHOOL_SERVICE,
    WATER_POINT_REPORT,
)

from .conftest import as_rows, as_set, padded


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_status_flags(spark):
    statuses = [
        "functional",
        "functional_need_repair",
        "not_functional",
        "abandoned",
        "archived",
        "on_construction",
        "unheard of",
        None,
    ]
    df = spark.createDataFrame([(s,) for s in statuses], "status string").coalesce(1)
    flags = {n: values(df, c) for n, c in ind.status_flags(F.col("status")).items()}
    assert flags["wp_functional"] == [1, 0, 0, 0, 0, 0, 0, 0]
    assert flags["wp_functional_needs_repair"] == [0, 1, 0, 0, 0, 0, 0, 0]
    assert flags["wp_non_functional"] == [0, 0, 1, 0, 0, 0, 0, 0]
    assert flags["wp_abandoned_archived"] == [0, 0, 0, 1, 1, 0, 0, 0]
    assert flags["wp_inconstruction"] == [0, 0, 0, 0, 0, 1, 0, 0]
    assert flags["wp_func_denominator"] == [1, 1, 1, 0, 0, 0, 0, 0]
    assert flags["wp_status_numeric"] == [1.0, 0.5, 0.0, 0.0, None, None, None, None]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(1, 2), (3, 2), (1, 0), (None, 2), (1, None)], "a int, b int"
    ).coalesce(1)
    a, b = F.col("a"), F.col("b")
    assert values(df, ratios.ratio(a, b)) == [0.5, 1.5, None, None, None]
    assert values(df, ratios.capped_ratio(a, b)) == [0.5, 1.0, None, None, None]


def test_percent_rounds_exact_halves_up(spark):
    df = spark.createDataFrame([(1, 800), (201, 20000)], "a int, b int").coalesce(1)
    assert values(df, ratios.percent(F.col("a"), F.col("b"), 2)) == [0.13, 1.01]


def test_period_keys(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '2001-08-15 13:00:00' AS ts, '2001' AS y, 'x' AS bad, ' 2001 ' AS s"
    )
    assert values(df, periods.period_start(F.col("ts"), "month")) == [dt.datetime(2001, 8, 1)]
    assert values(df, periods.period_start(F.col("ts"), "quarter")) == [dt.datetime(2001, 7, 1)]
    assert values(df, periods.period_start(F.col("ts"), "year")) == [dt.datetime(2001, 1, 1)]
    assert values(df, periods.year_stamp(F.col("y"))) == [dt.datetime(2001, 1, 1)]
    assert values(df, periods.year_stamp(F.col("s"))) == [dt.datetime(2001, 1, 1)]
    assert values(df, periods.year_stamp(F.col("bad"))) == [None]


@pytest.mark.parametrize(
    "as_of, start, stop",
    [
        (dt.date(2001, 8, 15), dt.datetime(2001, 5, 1), dt.datetime(2001, 8, 1)),
        (dt.date(2024, 2, 29), dt.datetime(2023, 11, 1), dt.datetime(2024, 2, 1)),
        (dt.date(2024, 1, 1), dt.datetime(2023, 10, 1), dt.datetime(2024, 1, 1)),
        (dt.date(2024, 12, 31), dt.datetime(2024, 9, 1), dt.datetime(2024, 12, 1)),
    ],
)
def test_full_months_before(spark, as_of, start, stop):
    bounds = spark.range(1).select(*periods.full_months_before(as_of, 3)).first()
    assert tuple(bounds) == (start, stop)


def test_yearly_rate_is_a_percentage_and_quarterly_a_fraction(spark):
    reports = spark.createDataFrame(
        [
            (dt.datetime(2024, 1, 5), "2024", "D1", "functional"),
            (dt.datetime(2024, 2, 5), "2024", "D1", "not_functional"),
            (dt.datetime(2024, 2, 6), "2024", "D1", None),
            (dt.datetime(2024, 2, 6), "2024", "D2", "archived"),
            (dt.datetime(2024, 2, 6), "2024", None, "functional"),
        ],
        "report_datetime timestamp_ntz, report_year string, district string,"
        " functionalitystatus string",
    )
    admin = spark.createDataFrame(
        [("R1", "North", "D1", "One")],
        "region_code string, region_name string, district_code string, district_name string",
    )
    detail = water_points.status_detail(padded(reports, WATER_POINT_REPORT))
    yearly = {r["district_code"]: r for r in water_points.district_rates(detail, admin).collect()}
    assert yearly["D1"]["func_rate_new"] == 50.0
    assert yearly["D1"]["region_name"] == "North"
    assert yearly["D2"]["func_rate_new"] is None and yearly["D2"]["func_denom"] == 0
    assert yearly["D2"]["district_name"] is None
    assert yearly[None]["func_rate_new"] == 100.0
    quarterly = water_points.district_rates(detail, admin, water_points.QUARTER)
    rates = {r["district_code"]: r["func_rate_new"] for r in quarterly.collect()}
    assert rates["D1"] == 0.5
    assert len(detail.columns) == 30 + 3 + 7


def household(spark, *rows):
    return spark.createDataFrame(
        rows,
        "lgacode string, regioncode string, reportdate date, createdat timestamp_ntz,"
        " toilettypea int, toilettypeb int, toilettypec int, toilettyped int, toilettypee int,"
        " toilettypef int, toilettypex int, handwashingstation int, hwfsoapwater int",
    ).coalesce(1)


DAY = dt.date(2024, 3, 1)


def test_household_rates(spark):
    df = household(
        spark,
        ("L", "R", DAY, None, 1, 1, None, 1, 1, None, 0, 8, None),
        ("L", "R", DAY, None, 0, 0, None, 0, 0, None, 0, 3, 2),
        ("L", "R", DAY, None, None, None, None, None, None, None, None, None, None),
    )
    rates = households.household_rates(df)
    assert values(rates, "totalhouseholds") == [4, 0, 0]
    assert values(rates, "improved_count_hhs") == [3, 0, 0]
    assert values(rates, "improved_perc_hhs") == [0.75, None, None]
    assert values(rates, "handwashstation_perc_hhs") == [1.0, None, None]
    assert values(rates, "handwashsoap_perc_hhs") == [None, None, None]


@pytest.fixture
def codes(spark):
    regions = spark.createDataFrame(
        [("R1", "North"), ("R2", "South")], "household_regioncode string, name string"
    )
    lgas = spark.createDataFrame(
        [("L1", "One", "{}")], "household_lgacode string, lganame string, geojson string"
    )
    return regions, lgas


def test_lga_means_leave_out_unknown_means(spark, codes):
    df = household(
        spark,
        ("L1", "R1", DAY, None, 1, 1, 0, 0, 0, 0, 0, 1, 1),
        ("L1", "R1", DAY, None, 3, 1, 0, 0, 0, 0, 0, 1, 1),
        ("L2", "R1", DAY, None, 3, 1, 0, 0, 0, 0, 0, None, 1),
        (None, "R9", None, None, 0, 1, 0, 0, 0, 0, 0, 1, 1),
    )
    means = households.lga_means(households.household_rates(df), *codes)
    found = {r["lgacode"]: r for r in means.collect()}
    assert set(found) == {"L1", None}
    assert found["L1"]["avg_improved_perc_hhs"] == 0.375
    assert found["L1"]["lga_name"] == "One"
    assert found[None]["region_name"] is None


def test_lga_means_by_date_take_the_region_created_first(spark, codes):
    early, late = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)
    df = household(
        spark,
        ("L1", "R2", DAY, None, 1, 1, 0, 0, 0, 0, 0, 1, 1),
        ("L1", "R2", DAY, late, 1, 1, 0, 0, 0, 0, 0, 1, 1),
        ("L1", "R1", DAY, early, 3, 1, 0, 0, 0, 0, 0, 1, 1),
        ("L1", "R2", None, early, 3, 1, 0, 0, 0, 0, 0, 1, 1),
        ("L9", "R2", DAY, early, 3, 1, 0, 0, 0, 0, 0, 1, 1),
    )
    rows = households.lga_means_by_date(households.household_rates(df), *codes).collect()
    assert len(rows) == 1
    assert rows[0]["regioncode"] == "R1" and rows[0]["region_name"] == "North"
    assert rows[0]["avg_improved_perc_hhs"] == pytest.approx((0.5 + 0.5 + 0.25) / 3)


def test_only_undated_reports_still_give_a_region(spark, codes):
    df = household(
        spark,
        ("L1", "R2", DAY, None, 1, 1, 0, 0, 0, 0, 0, 1, 1),
        ("L1", None, DAY, None, 1, 1, 0, 0, 0, 0, 0, 1, 1),
    )
    rows = households.lga_means_by_date(households.household_rates(df), *codes).collect()
    assert [r["regioncode"] for r in rows] == ["R2"]


def test_household_flags(spark, codes):
    df = household(
        spark,
        ("L1", "R1", DAY, None, 0, 0, 0, 0, 0, 0, 0, 1, 1),
        ("L9", "R1", DAY, None, 1, 0, 0, 0, 0, 0, 0, 1, 1),
    )
    detail = households.household_detail(df, *codes)
    run_ts = dt.datetime(2024, 7, 1)
    flags = households.quality_flags(detail, run_ts).collect()
    assert [(f["id"] - run_number(run_ts), f["error_alert_type"]) for f in flags] == [
        (1, "unrealistic_values"),
        (3, "missing_data"),
    ]
    later = households.quality_flags(detail, run_ts + dt.timedelta(seconds=1)).collect()
    assert len({f["id"] for f in [*flags, *later]}) == 4, "ids are unique over runs"
    assert flags[0]["reportdate"] == dt.date(2024, 7, 1)
    clean = households.household_detail(df.where("false"), *codes)
    assert households.quality_flags(clean, dt.datetime(2024, 7, 1)).count() == 0


def test_village_counts_keep_unknown_groups_null(spark):
    df = spark.createDataFrame(
        [
            ("A", 60.0, 1, True, "no_service", True),
            ("A", 80.0, 1, True, "piped", False),
            ("A", None, 1, True, None, None),
            ("A", 10.0, 0, True, "piped", False),
            ("B", 10.0, None, True, None, None),
            ("C", 10.0, 1, False, None, None),
        ],
        "lgacode string, infracoverage double, status int, isvillage boolean, servicetype string,"
        " servedbyagency boolean",
    )
    found = {r["lgacode"]: tuple(r)[1:] for r in scorecard.service_levels(df).collect()}
    assert found["A"] == (50.0, 3, 1, 1, 1)
    assert found["B"] == (10.0, None, None, None, None)
    assert found["C"] == (10.0, 0, 0, 0, 0)


def test_coverage_date_is_taken_before_the_filter(spark):
    reports = spark.createDataFrame(
        [
            ("D1", dt.datetime(2024, 1, 1, 5), 50.0),
            ("D1", dt.datetime(2024, 1, 2, 5), 70.0),
            ("D1", dt.datetime(2024, 1, 2, 23), 80.0),
            ("D2", dt.datetime(2024, 1, 2, 6), 0.0),
        ],
        "district string, report_datetime timestamp_ntz, infracoverage double",
    )
    admin = spark.createDataFrame(
        [("R1", "North", "D1", "One")],
        "region_code string, region_name string, district_code string, district_name string",
    )
    latest = coverage.coverage_latest(reports, admin)
    assert as_set(latest.select("district_code", "avg_infracoverage")) == {("D1", 75.0)}
    yearly = coverage.coverage_yearly(reports, admin).select("district_code", "year_timestamp")
    year = dt.datetime(2024, 1, 1)
    assert as_set(yearly) == {("D1", year), ("D2", year)}
    zero = reports.where("district = 'D2'")
    assert coverage.coverage_latest(zero, admin).count() == 0


# --- schools ----------------------------------------------------------------


def school(spark, **columns):
    """One school row with the given columns; the rest NULL, as after the joins."""
    from sectorloom.sources.schemas import SCHOOL_COMBINED, conform, names

    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return schools.assess(conform(df, SCHOOL_COMBINED, names(SCHOOL_COMBINED))).first()


@pytest.mark.parametrize(
    "number, category",
    [
        ("EM.1", "Primary/Pre-Primary"),
        ("ES.2", "Primary/Pre-Primary"),
        ("S.3", "Secondary"),
        ("S3", "Unknown"),
        ("EM", "Primary/Pre-Primary"),
        ("X.1", "Unknown"),
    ],
)
def test_school_category(spark, number, category):
    assert school(spark, schoolregnumber=number)["school_category"] == category


@pytest.mark.parametrize(
    "source, improved",
    [
        ("Maji ya BOMBA", 1),
        ("default value", 1),
        ("maji ya mto na visima vifupi", 1),
        ("MAJI YA MTO", 0),
        ("chemchem", 0),
        ("other", None),
        (None, None),
    ],
)
def test_improved_water_source(spark, source, improved):
    row = school(spark, schoolregnumber="S.1", watersource=source)
    assert row["improved_water_source"] == improved


@pytest.mark.parametrize(
    "flags, improved",
    [
        ({}, None),
        ({"toilettypeftconnpit": True}, 1),
        ({"toilettypeftconnpit": False}, None),
        ({"toilettypeftconnpit": True, "toilettypeothers": True}, 0),
        ({"toilettypeftconnpit": True, "toilettypeothers": False}, 1),
        ({"toilettypeopenpitlatrine": True}, 0),
    ],
)
def test_improved_toilet_type(spark, flags, improved):
    assert school(spark, schoolregnumber="S.1", **flags)["improved_toilet_type"] == improved


@pytest.mark.parametrize(
    "columns, lockable",
    [
        ({"schoolregnumber": "S.1"}, False),
        ({"schoolregnumber": "EM.1"}, True),
        ({"schoolregnumber": "EM.1", "latrineslockable": False}, True),
        ({"schoolregnumber": "S.1", "latrinesmaintained": True}, True),
        ({"schoolregnumber": "S.1", "specialgirlsroom": True, "latrineslockable": False}, True),
        ({"schoolregnumber": "S.1", "latrineslockable": True}, True),
    ],
)
def test_latrine_defaults(spark, columns, lockable):
    row = school(spark, **columns)
    assert row["latrineslockable"] is lockable
    assert row["latrinesmaintained"] is columns.get("latrinesmaintained", False)
    assert row["specialgirlsroom"] is columns.get("specialgirlsroom", False)


@pytest.mark.parametrize(
    "pupils, girls, boys, holes, special, met, over",
    [
        (1000.0, 400.0, 500.0, 10, 1, True, False),
        (1000.0, 410.0, 500.0, 10, 1, False, False),
        (1500.0, 500.0, 650.0, 10, 1, True, True),
        (1500.0, 500.0, 660.0, 10, 1, False, True),
        (1000.0, 400.0, 500.0, 10, 0, False, False),
        (1000.0, 400.0, 500.0, 0, 1, False, False),
        (None, 400.0, 500.0, 10, 1, False, None),
        (1000.0, None, 500.0, 10, 1, False, False),
    ],
)
def test_drophole_ratio(spark, pupils, girls, boys, holes, special, met, over):
    row = school(
        spark,
        schoolregnumber="S.1",
        total_pupils=pupils,
        girl_pupils=girls,
        boy_pupils=boys,
        dropholesgirls=holes,
        dropholesboys=holes,
        dropholesspecialneedsboys=special,
    )
    assert row["meet_drophole_ratio"] is met
    assert row["enrollment_over1500"] is over
    assert (row["boys_per_drophole"] is None) == (holes == 0)


@pytest.mark.parametrize(
    "men, women, separate",
    [(1, 1, True), (0, 1, False), (None, 1, None), (1, None, None), (0, None, None)],
)
def test_separate_teacher_latrines(spark, men, women, separate):
    row = school(
        spark, schoolregnumber="S.1", dropholesmaleteachers=men, dropholesfemaleteachers=women
    )
    assert row["separate_latrines_teachers"] is separate
    assert row["improved_sanitation_school"] is None


def test_improved_sanitation(spark):
    good = dict(
        schoolregnumber="S.1",
        toilettypeftconnpit=True,
        total_pupils=100.0,
        girl_pupils=50.0,
        boy_pupils=50.0,
        dropholesgirls=5,
        dropholesboys=5,
        dropholesspecialneedsgirls=1,
        dropholesmaleteachers=1,
        dropholesfemaleteachers=1,
    )
    assert school(spark, **good)["improved_sanitation_school"] == 1
    assert school(spark, **good, toilettypeothers=True)["improved_sanitation_school"] == 0
    assert school(spark, **{**good, "dropholesboys": 0})["improved_sanitation_school"] == 0


def test_school_sources_with_several_years_and_duplicates(spark):
    services = spark.createDataFrame(
        [("S.1", dt.date(2024, 1, 1)), ("S.1", dt.date(2023, 1, 1)), ("S.2", dt.date(2024, 12, 31))],
        "schoolregnumber string, reportdate date",
    )
    reports = spark.createDataFrame(
        [("S.1", "L1", dt.date(2022, 1, 1)), ("S.1", "L2", dt.date(2024, 1, 1))],
        "schoolregnumber string, lgacode string, reportdate date",
    )
    infrastructure = spark.createDataFrame(
        [("S.1", 3, dt.date(2024, 5, 1)), ("S.2", 9, dt.date(2023, 5, 1))],
        "schoolregnumber string, dropholesboys int, reportdate date",
    )
    enrollment = spark.createDataFrame(
        [("S.1", "12", "x", None), ("S.9", "1", "1", "2")],
        "schoolregnumber string, totalgirls string, totalboys string, totalpupils string",
    )
    services, reports = padded(services, SCHOOL_SERVICE), padded(reports, SCHOOL_REPORT)
    infrastructure = padded(infrastructure, SCHOOL_FACILITIES)
    admin = spark.createDataFrame(
        [("L2", "North", "Two")], "school_lgacode string, region_name string, lga_name string"
    )
    combined = schools.school_combined(services, reports, infrastructure, enrollment, admin, 2024)
    picked = combined.select(
        "schoolregnumber", "lga_code", "lga_name", "dropholesboys", "girl_pupils", "boy_pupils"
    )
    assert as_rows(picked) == [
        ("S.1", "L2", "Two", 3, 12.0, None),
        ("S.2", None, None, None, None, None),
    ]
    assert len(combined.columns) == 60
    twice = services.unionAll(services)
    with pytest.raises(Exception, match="schoolregnumber is repeated"):
        schools.school_combined(twice, reports, infrastructure, enrollment, admin, 2024).collect()


def test_latest_report_is_found_whatever_the_case_of_its_name(spark):
    services = padded(
        spark.createDataFrame([("S.1", dt.date(2024, 1, 1))], "schoolregnumber string, reportdate date"), SCHOOL_SERVICE
    )
    reports = spark.createDataFrame(
        [("S.1", "A", dt.date(2022, 1, 1)), ("S.1", "Z", dt.date(2024, 1, 1))],
        "schoolregnumber string, lgacode string, ReportDate date",
    )
    infrastructure = padded(services.select("schoolregnumber", "reportdate"), SCHOOL_FACILITIES)
    enrollment = services.selectExpr("schoolregnumber", "1 AS totalpupils", "1 AS totalgirls", "0 AS totalboys")
    admin = spark.createDataFrame([("Z", "N", "L")], "School_LgaCode string, region_name string, lga_name string")
    combined = schools.school_combined(
        services, padded(reports, SCHOOL_REPORT), infrastructure, enrollment, admin, 2024
    )
    assert [(r["lga_code"], r["lga_name"]) for r in combined.collect()] == [("Z", "L")]


def test_year_text_may_go_on(spark):
    df = spark.createDataFrame([("2023/24",), (" 2021",), ("24",), ("20234",), ("x",)], "y string")
    years = [r[0] and r[0].year for r in df.select(periods.year_stamp(F.col("y"))).collect()]
    assert years == [2023, 2021, None, None, None]
