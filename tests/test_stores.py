"""Publishing under readers, crashes at every step, and logs of several runs."""

import threading
import uuid
from pathlib import Path

import pytest

from sectorloom import fixtures
from sectorloom.operators.sizing import measure
from sectorloom.plans import refresh, water_points
from sectorloom.sources.stores import RAW, FolderStore, TableStore

from .conftest import SMALL, as_rows, plan


@pytest.fixture
def tables(spark):
    database = f"s_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    yield TableStore(spark, dict.fromkeys(("raw", "marts", "quality"), database))
    spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.fixture
def folders(spark, tmp_path):
    return FolderStore(spark, str(tmp_path))


@pytest.fixture(params=["tables", "folders"])
def store(request):
    return request.getfixturevalue(request.param)


def names(store):
    database = store.databases["marts"]
    return {t.name: t.tableType for t in store.spark.catalog.listTables(database)}


def test_readers_never_miss_the_table(spark, store):
    """Every read during 50 publishes finds one whole version, and versions don't go back."""
    store.replace("lga_scorecard", spark.range(1).selectExpr("0 AS n"))
    seen, failed, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                rows = store.read("lga_scorecard").collect()
                seen.append({r["n"] for r in rows})
                assert len(rows) == rows[0]["n"] + 1
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    reader = threading.Thread(target=read, daemon=True)
    reader.start()
    try:
        for n in range(1, 51):
            store.replace("lga_scorecard", spark.range(n + 1).selectExpr(f"{n} AS n"))
    finally:
        done.set()
        reader.join()
    assert not failed
    assert len(seen) > 10 and all(len(x) == 1 for x in seen)
    order = [min(x) for x in seen]
    assert order == sorted(order) and store.read("lga_scorecard").count() == 51


def test_a_crash_at_any_step_leaves_a_whole_mart(spark, tables):
    """The k-th statement of a publish fails, for every k, on the first, second and sixth publish."""

    class Crash(Exception):
        pass

    def publish(rows, fail_at):
        calls = 0

        class Session:
            def __getattr__(self, name):
                return getattr(spark, name)

            def sql(self, text):
                nonlocal calls
                calls += 1
                if calls == fail_at:
                    raise Crash(text)
                return spark.sql(text)

        tables.spark = Session()
        try:
            tables._publish(tables._stage(location, spark.range(rows).toDF("id"), ()), location)
        finally:
            tables.spark = spark
        return calls

    location = tables.location("household_lga")
    rows = 0
    for before in (0, 1, 5):
        crashes = 0
        for fail_at in range(1, 10):
            try:
                publish(rows + 1, fail_at)
            except Crash:
                crashes += 1
            found = tables.read("household_lga").count() if tables.exists("household_lga") else 0
            assert found in (rows, rows + 1)
            rows = found
        assert crashes >= (1 if before == 0 else 3)
        for _ in range(before):
            rows += 1
            tables.replace("household_lga", spark.range(rows).toDF("id"))
    assert len(names(tables)) > tables.keep + 2, "crashes leave versions that nothing shows"
    tables.sweep("household_lga")
    kinds = names(tables)
    assert kinds.pop("household_lga") == "VIEW" and len(kinds) == tables.keep + 1
    assert tables.read("household_lga").count() == rows


def test_a_plain_table_becomes_the_first_version(spark, tables):
    location = tables.location("household_lga")
    spark.range(3).toDF("id").write.saveAsTable(location)
    assert tables.read("household_lga").count() == 3
    tables.replace("household_lga", spark.range(4).selectExpr("id", "'x' AS more"))
    assert tables.read("household_lga").columns == ["id", "more"]
    assert tables.read("household_lga").count() == 4
    assert names(tables)["household_lga"] == "VIEW" and len(names(tables)) == 3


def test_superseded_versions_go(spark, store, tmp_path):
    for n in range(1, 9):
        store.replace("household_lga", spark.range(n).toDF("id"))
    assert store.read("household_lga").count() == 8
    if isinstance(store, TableStore):
        assert len(names(store)) == store.keep + 2
    else:
        assert len(list((tmp_path / "marts/household_lga").iterdir())) == store.keep + 1


def test_two_publishes_at_once(spark, store):
    """Neither loses its stage to the other; one of both is the table."""
    store.replace("household_lga", spark.range(1).toDF("id"))
    failed = []

    def publish(n):
        try:
            for _ in range(4):
                store.replace("household_lga", spark.range(n).toDF("id"))
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=publish, args=(n,)) for n in (100, 200)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and store.read("household_lga").count() in (100, 200)


def entry(spark, run, n=1, text="x"):
    return spark.range(n).selectExpr(f"id + {run} AS id", f"'{text}' AS check_name")


def files(store, tmp_path):
    """Log files and when they were written."""
    if isinstance(store, TableStore):
        folder = store._described(store.location("qc_log"))["Location"].removeprefix("file:")
    else:
        folder = tmp_path / "quality/qc_log"
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_a_log_is_never_rewritten(spark, store, tmp_path):
    for run in range(100, 700, 100):
        before = files(store, tmp_path) if run > 100 else {}
        store.record("qc_log", entry(spark, run), run, "schools")
        after = files(store, tmp_path)
        assert before.items() <= after.items(), "no earlier file is touched"
        assert len(after) - len(before) <= 2
    assert as_rows(store.read("qc_log").select("id")) == [(run,) for run in range(100, 700, 100)]


def test_a_repeated_run_leaves_its_rows_once(spark, store, tmp_path):
    store.record("qc_log", entry(spark, 100, 3), 100, "schools")
    store.record("qc_log", entry(spark, 200, 2), 200, "schools")
    store.record("qc_log", entry(spark, 150), 100, "other")
    store.record("qc_log", entry(spark, 100, 2, "again"), 100, "schools")
    assert as_rows(store.read("qc_log")) == [
        (100, "again"), (101, "again"), (150, "x"), (200, "x"), (201, "x"),
    ]
    store.record("qc_log", entry(spark, 100, 0), 100, "schools")
    assert as_rows(store.read("qc_log")) == [(150, "x"), (200, "x"), (201, "x")]
    assert store.read("qc_log").columns == ["id", "check_name"]


def test_a_failing_attempt_keeps_the_rows_of_the_run(spark, tables):
    tables.record("qc_log", entry(spark, 100), 100, "schools")
    broken = spark.range(2).selectExpr("id", "CAST(raise_error('broken') AS STRING) AS check_name")
    with pytest.raises(Exception, match="broken"):
        tables.record("qc_log", broken, 100, "schools")
    assert as_rows(tables.read("qc_log")) == [(100, "x")]


def test_runs_at_the_same_time_keep_the_rows_of_both(spark, store):
    failed = []

    def record(run):
        try:
            for _ in range(3):
                store.record("qc_log", entry(spark, run, 5), run, "schools")
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=record, args=(run,)) for run in (100, 200, 300)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed, failed
    assert store.read("qc_log").count() == 15


def test_published_marts_know_their_sizes(spark, store, tmp_path):
    """The map of located points is planned from published marts without a job."""
    source = fixtures.Source(spark, SMALL)
    store.inputs = {name: source[name] for name in RAW}
    run = refresh.Run(fixtures.AS_OF, fixtures.YEAR, fixtures.RUN_TS, 1, 10_000)
    for build in (refresh.build_shapes, refresh.build_admin_lookup, refresh.build_water_points):
        build(store, run)
    store.replace("household_lga", store.read("villages"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    try:
        marts = [store.read(name) for name in ("water_point_detail", "admin_lookup", "household_lga")]
        before = set(tracker.getJobIdsForGroup("plan"))
        located = water_points.latest_located(*marts, run.as_of)
        assert set(tracker.getJobIdsForGroup("plan")) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "BroadcastHashJoin" in plan(located) and "SortMergeJoin" not in plan(located)
    expected = water_points.latest_located(marts[0], source["lgas"].sparkSession.createDataFrame(marts[1].collect(), marts[1].schema), store.read("villages"), run.as_of)
    assert as_rows(located) == as_rows(expected)


def test_observed_sizes_equal_measured_ones(spark, store):
    rows = [("é" * i, i, None, {"a": "x" * i}) for i in range(30)]
    df = spark.createDataFrame(rows, "text string, n int, nothing string, nested map<string,string>")
    store.columns = {"household_lga": {"text": "their_text"}}
    store.replace("household_lga", df)
    read = store.read("household_lga")
    for columns in (None, ["text"], ["n", "nothing"], ["nested"]):
        assert measure(read, columns) == measure(spark.createDataFrame(rows, df.schema), columns)
    store.replace("household_lga", df.where("false"))
    assert measure(store.read("household_lga")).rows == 0
