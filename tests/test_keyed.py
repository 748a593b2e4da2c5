"""Lookups, one row per key, key checks."""

import pytest
from pyspark.sql import functions as F

from sectorloom.operators import keyed, sizing

from .conftest import as_rows, as_set, plan


@pytest.fixture
def facts(spark):
    """A third of the rows share one key and some have none."""
    return spark.range(3000).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL"
        " ELSE 'k' || CAST(id % 500 AS STRING) END AS code",
    )


@pytest.fixture
def lookup(spark):
    rows = [("hot", "Hot", 1), ("hot", "Hotter", 2), (None, "none", 0)]
    rows += [(f"k{i}", f"name{i}", i) for i in range(0, 500, 2)]
    return spark.createDataFrame(rows, "code string, name string, n int")


def brute_force(facts, lookup):
    best = {}
    for code, name, _ in lookup.collect():
        if code is not None and (code not in best or name < best[code]):
            best[code] = name
    return sorted(((i, c, best.get(c)) for i, c in facts.collect()), key=repr)


def test_lookup_broadcast_equals_brute_force(facts, lookup):
    joined = keyed.lookup_join(facts, lookup, ("code", "code"), {"name": "name"})
    assert "BroadcastHashJoin" in plan(joined)
    assert as_rows(joined) == brute_force(facts, lookup)


def test_lookup_by_shuffle_equals_brute_force(facts, lookup, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_ROWS", 0)
    joined = keyed.lookup_join(facts, lookup, ("code", "code"), {"name": "name"}, ["id"])
    assert as_rows(joined) == brute_force(facts, lookup)
    spread_by_all = keyed.lookup_join(facts, lookup, ("code", "code"), {"name": "name"})
    assert as_rows(spread_by_all) == brute_force(facts, lookup)


def test_shuffle_spreads_hot_and_missing_keys(spark, facts, lookup, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_ROWS", 0)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = keyed.lookup_join(facts, lookup, ("code", "code"), {"name": "name"}, ["id"])
        assert "SortMergeJoin" in plan(joined)
        sizes = [
            r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert sum(sizes) == 3000
    assert max(sizes) < 3000 / 3


def test_heavy_keys_are_those_above_an_even_share(spark, facts):
    reducers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = keyed.heavy_keys(facts, ["code", "id"])
    assert heavy == {"code": {"hot": -(-reducers * 1000 // 3000)}, "id": {}}


def test_more_hot_keys_than_any_fixed_number(spark, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_ROWS", 0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        facts = spark.range(6000).selectExpr("id", "IF(id % 2 = 0, id, id % 90) % 100 AS code")
        assert len(keyed.heavy_keys(facts, ["code"])["code"]) > 64
        names = spark.range(100).selectExpr("id AS code", "'n' || id AS name")
        joined = keyed.lookup_join(facts, names, ("code", "code"), {"name": "name"}, ["id"])
        assert joined.where("name = 'n' || code").count() == 6000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_large_lookups_read_the_facts_once(spark, tmp_path, facts, lookup, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_ROWS", 0)
    facts.write.parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    for n in (1, 4):
        lookups = [keyed.Lookup(lookup, ("code", "code"), {f"name{i}": "name"}) for i in range(n)]
        joined = keyed.lookup_joins(stored, lookups, ["id"])
        assert plan(joined, "formatted").count("Scan parquet") in (1, 2)  # listed once, and in its details
        assert joined.count() == 3000


def test_lookup_replaces_a_column_of_the_same_name(spark, lookup):
    df = spark.createDataFrame([("k2", "old"), ("zz", "old")], "code string, name string")
    joined = keyed.lookup_join(df, lookup, ("code", "code"), {"name": "name"})
    assert as_set(joined) == {("k2", "name2"), ("zz", None)}


def test_newest_match_wins(spark):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("a", None, "w"), (None, 9, "q")]
    df = spark.createDataFrame(rows, "k string, year int, v string")
    assert as_set(keyed.one_match(df, "k", {"v": "v"}, "year")) == {("a", "z")}
    assert as_set(keyed.one_match(df, "k", {"v": "v"})) == {("a", "w")}


def test_large_lookup_with_few_keys_is_broadcast(spark, facts, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_ROWS", 10)
    labels = spark.range(100).selectExpr("'k' || CAST(id % 5 AS STRING) AS code", "'n' AS name")
    joined = keyed.lookup_join(facts, labels, ("code", "code"), {"name": "name"})
    assert "__left_salt" not in plan(joined)
    assert joined.count() == 3000


def test_measure_counts_rows_and_bytes(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int")
    size = sizing.measure(df)
    assert size.rows == 2 and 2 <= size.bytes <= 100
    assert sizing.fits_in_broadcast(df)
    assert sizing.measure(df.where("false")).rows == 0


def test_first_per_key_trims_before_the_shuffle(facts):
    first = keyed.first_per_key(facts, ["code"], [F.col("id").desc()])
    text = plan(first)
    assert text.count("WindowGroupLimit") == 2
    by_code = {c: i for i, c in first.collect()}
    expected = {c: i for i, c in sorted(facts.collect())}
    assert by_code == expected


def test_unmatched_keeps_duplicates_and_null_keys(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("b",), (None,)], "k string")
    assert as_rows(keyed.unmatched(left, right, ("k", "k"))) == [("a",), ("a",), (None,)]


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2)], "k string, n int")
    assert as_set(keyed.key_violations(df, ["k", "n"])) == {("a", 1, 2), (None, 2, 1)}


def test_enforce_key(spark):
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    assert as_set(keyed.enforce_key(good, "k")) == {("a", 1), ("b", 2)}
    for bad in ([("a", 1), ("a", 2)], [(None, 1)]):
        df = spark.createDataFrame(bad, "k string, n int")
        with pytest.raises(Exception, match="k is repeated or NULL"):
            keyed.enforce_key(df, "k").collect()


def test_measure_reads_needed_columns_and_charges_true_widths(spark, tmp_path):
    rows = spark.range(10).selectExpr(
        "id AS code", "repeat('x', 1000) AS shape", "array_repeat(7, 1000) AS list",
        "CAST(repeat('y', 3000) AS BINARY) AS raw",
    )
    rows.write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    assert sizing.measure(wide, ["code"]).bytes < 1000
    assert sizing.measure(wide, ["list"]).bytes >= 10 * 2000
    assert sizing.measure(wide, ["raw"]).bytes >= 10 * 3000
    assert sizing.measure(wide, ["CODE", "Shape"]).bytes >= 10 * 1000
