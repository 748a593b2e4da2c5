"""Streams give the batch answer, also when data comes in parts and batches are repeated."""

import datetime as dt

import pytest

from sectorloom.plans import households, periodic, school_quality
from sectorloom.streaming.changes import signed_rows
from sectorloom.streaming.refresh import start_quality_flags, start_refresh
from sectorloom.streaming.school_checks import start_school_checks, streamed_presence

from .conftest import as_rows


@pytest.fixture
def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "ts AS date_recorded", "event_type AS region", "value AS functioning_percentage"
    )


def rounded(df):
    return as_rows(df.selectExpr("year", "region", "round(percentage, 6) AS percentage"))


def test_refresh_follows_new_files(spark, events, tmp_path):
    source, mart, state = (str(tmp_path / n) for n in ("source", "mart", "state"))
    events.where("hash(date_recorded) % 2 = 0").write.parquet(source)

    def catch_up():
        stream = spark.readStream.schema(events.schema).parquet(source)
        query = start_refresh(
            periodic.functioning_by_year_region(stream),
            lambda df: df.write.mode("overwrite").parquet(mart),
            state,
        )
        query.awaitTermination()
        return spark.read.parquet(mart)

    part = spark.read.parquet(source)
    assert rounded(catch_up()) == rounded(periodic.functioning_by_year_region(part))
    events.where("hash(date_recorded) % 2 <> 0").write.mode("append").parquet(source)
    assert rounded(catch_up()) == rounded(periodic.functioning_by_year_region(events))
    assert rounded(catch_up()) == rounded(periodic.functioning_by_year_region(events))


def test_batch_rebuild_covers_updates_and_deletes(events):
    changed = events.where("region <> 'click'").selectExpr(
        "date_recorded", "region", "functioning_percentage + 1 AS functioning_percentage"
    )
    before = {(r["year"], r["region"]): r["percentage"] for r in
              periodic.functioning_by_year_region(events).collect()}
    for row in periodic.functioning_by_year_region(changed).collect():
        assert row["region"] != "click"
        assert row["percentage"] == pytest.approx(before[row["year"], row["region"]] + 1)


def test_quality_flags_per_batch(spark, tmp_path):
    schema = "lgacode string, regioncode string, handwashingstation int, hwfsoapwater int, "
    schema += ", ".join(f"toilettype{k} int" for k in "abcdefx")
    regions = spark.createDataFrame([("R1", "North")], "household_regioncode string, name string")
    lgas = spark.createDataFrame([("L1", "One")], "household_lgacode string, lganame string")
    source, flags, state = (str(tmp_path / n) for n in ("source", "flags", "state"))

    def add(lga, toilets):
        row = (lga, "R1", 1, 1, *[toilets] * 7)
        spark.createDataFrame([row], schema).write.mode("append").parquet(source)

    def check(batch):
        detail = households.household_detail(batch, regions, lgas, include_geojson=False)
        return households.quality_flags(detail, dt.datetime(2024, 7, 1))

    def catch_up(checkpoint=state):
        stream = spark.readStream.schema(schema).parquet(source)
        start_quality_flags(stream, check, flags, checkpoint).awaitTermination()
        return as_rows(spark.read.parquet(flags).selectExpr("batch_id", "id % 100"))

    add("L1", 1)
    assert catch_up() == []
    add("L1", 0)
    assert catch_up() == [(1, 1)]
    add("L9", 1)
    assert catch_up() == [(1, 1), (2, 3)]
    assert catch_up() == [(1, 1), (2, 3)]
    # A lost checkpoint runs the files again as batch 0; nothing is added twice to a batch.
    again = str(tmp_path / "again")
    assert catch_up(again) == [(0, 1), (0, 3), (1, 1), (2, 3)]


ROW = "struct<date_recorded:timestamp_ntz,region:string,functioning_percentage:double>"
DATE = dt.datetime(2024, 3, 1)


def change(before=None, after=None):
    return tuple(None if row is None else (row[2] if len(row) > 2 else DATE, row[0], row[1]) for row in (before, after))


def test_means_follow_updates_and_deletes(spark, tmp_path):
    source, mart, state = (str(tmp_path / n) for n in ("source", "mart", "state"))
    schema = f"before {ROW}, after {ROW}"

    def catch_up(*changes):
        spark.createDataFrame(list(changes), schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        query = start_refresh(
            periodic.functioning_of_changes(signed_rows(stream)),
            lambda df: df.write.mode("overwrite").parquet(mart),
            state,
        )
        query.awaitTermination()
        return {r["region"]: r["percentage"] for r in spark.read.parquet(mart).collect()}

    assert catch_up(
        change(None, ("a", 10.1)), change(None, ("a", 20.2)), change(None, ("b", 0.1)), change(None, ("c", None))
    ) == {"a": 15.15, "b": 0.1, "c": None}
    assert catch_up(change(("a", 20.2), ("a", 0.3))) == {"a": 5.2, "b": 0.1, "c": None}, "a mean can shrink"
    assert catch_up(change(("a", 10.1), ("b", 0.3)), change(("c", None), ("c", 7.0))) == {"a": 0.3, "b": 0.2, "c": 7.0}
    assert catch_up(change(("b", 0.1), None), change(("b", 0.3), None)) == {"a": 0.3, "c": 7.0}, "an empty group goes"
    assert catch_up(change(None, ("b", 1e9)), change(("b", 1e9), ("b", 0.1))) == {"a": 0.3, "b": 0.1, "c": 7.0}
    with pytest.raises(Exception, match="taken back"):
        catch_up(change(("nowhere", 1.0), None))


def test_changes_equal_the_batch_plan(spark, events):
    """Any feed leaves the mean of the rows that are left."""
    feed = events.selectExpr(
        "named_struct('date_recorded', date_recorded, 'region', region,"
        " 'functioning_percentage', functioning_percentage) AS row", "hash(*) AS h"
    )
    kept = feed.where("h % 2 = 0")
    gone = feed.where("h % 2 <> 0")
    changes = (
        kept.selectExpr("NULL AS before", "row AS after")
        .unionByName(gone.selectExpr("NULL AS before", "row AS after"))
        .unionByName(gone.selectExpr("row AS before", "NULL AS after"))
    )
    got = periodic.functioning_of_changes(signed_rows(changes))
    assert rounded(got) == rounded(periodic.functioning_by_year_region(kept.select("row.*")))


def test_school_checks_change_when_a_partner_arrives(spark, tmp_path):
    kinds = {
        "services": "schoolregnumber string, reportdate date",
        "reports": "schoolregnumber string",
        "infrastructure": "schoolregnumber string",
    }
    day, before = dt.date(2024, 6, 30), dt.date(2023, 6, 30)
    found, state = str(tmp_path / "found"), str(tmp_path / "state")
    for name, schema in kinds.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))

    def arrive(services=(), reports=(), infrastructure=()):
        rows = {"services": services, "reports": [(x,) for x in reports], "infrastructure": [(x,) for x in infrastructure]}
        streams = []
        for name, schema in kinds.items():
            if rows[name]:
                spark.createDataFrame(list(rows[name]), schema).write.mode("append").parquet(str(tmp_path / name))
            streams.append(spark.readStream.schema(schema).parquet(str(tmp_path / name)))
        counts = streamed_presence(*streams, 2024)
        start_school_checks(counts, dt.datetime(2024, 7, 1), found, state).awaitTermination()
        log = spark.read.parquet(found)
        last = log.agg({"batch_id": "max"}).first()[0]
        return last, {
            r["check_name"]: int(r["result_value"]) for r in log.where(f"batch_id = {last}").collect() if r["result_value"] != "0"
        }

    first, got = arrive(services=[("A", day), ("B", day), ("C", before), (None, day)], infrastructure=["A"])
    assert got == {
        "unique_schools_services": 2,
        "unmatched_services_not_in_reports": 3,
        "unique_schools_infrastructure": 1,
        "matched_combined_infrastructure": 1,
        "combined_not_in_infra": 2,
    }
    second, got = arrive(reports=["A", "A", "C", "X"])
    assert second > first
    assert got["matched_services_reports"] == 1 and got["unmatched_services_not_in_reports"] == 2
    assert got["unmatched_reports_not_in_services"] == 1, "C is known, though not of this year"
    third, got = arrive(services=[("X", day)], reports=["B"], infrastructure=["B", "Z"])
    assert got["matched_services_reports"] == 3 and "unmatched_reports_not_in_services" not in got
    assert got["infra_not_in_combined"] == 1
    batch = school_quality.key_presence(
        *[spark.read.schema(schema).parquet(str(tmp_path / name)) for name, schema in kinds.items()],
        spark.read.schema(kinds["services"]).parquet(str(tmp_path / "services")).where("year(reportdate) = 2024"),
        2024,
    )
    expected = school_quality.presence_log(batch, dt.datetime(2024, 7, 1))
    log = spark.read.parquet(found)
    assert as_rows(log.where(f"batch_id = {third}").select(*expected.columns)) == as_rows(expected)
    assert [r[0] for r in log.groupBy("batch_id").count().select("count").collect()] == [9] * 3
    assert arrive()[0] == third, "nothing new, no batch"
