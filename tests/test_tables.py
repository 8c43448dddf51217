"""Inserts, upserts, lookups, ids, integrity and the store."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tremorlake.operators import tables as t
from tremorlake.operators.filters import EventFilter
from tremorlake.operators.joins import lookup_join
from tremorlake.operators.ordering import row_ids, running_total
from tremorlake.sources import store
from test_functions import events

LOCATION = "quake_id LONG, country_iso STRING, sea_id INT"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_first_write_wins_and_null_keys_stay(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 1, "z"), (None, 1, "z"), ("b", 5, "w")], "k STRING, o INT, v STRING")
    assert rows(t.first_write_wins(df, "k", ["o"])) == sorted([("a", 1, "y"), (None, 1, "z"), (None, 1, "z"), ("b", 5, "w")], key=str)


def test_insert_new_never_updates(spark):
    stored = spark.createDataFrame([("a", 1), (None, 2)], "usgs_id STRING, id INT")
    batch = spark.createDataFrame([("a", 10), ("b", 11), ("b", 12), (None, 13)], "usgs_id STRING, id INT")
    new = t.insert_new(stored, batch)
    assert rows(new) == sorted([("b", 11), (None, 13)], key=str)
    again = t.insert_new(stored.unionByName(new), batch.where("usgs_id IS NOT NULL"))
    assert again.isEmpty()
    assert t.insert_new(stored, batch.limit(0)).isEmpty()
    assert rows(t.anti_existing(batch, stored, "usgs_id")) == sorted([("b", 11), ("b", 12), (None, 13)], key=str)


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    once = t.first_write_wins(df, "k", ["id"])
    assert once.count() == 20_001
    plan = once._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


@pytest.mark.parametrize("partitions", [1, 5, None])
def test_ids_and_running_sums_cross_partitions(spark, partitions):
    df = spark.range(2_000).select((F.col("id") % 7).alias("hot"), "id", F.lit(2).alias("n"))
    numbered = row_ids(df, ["hot", "id"], 100, "row", partitions).orderBy("hot", "id")
    assert [r["row"] for r in numbered.collect()] == list(range(100, 2_100))
    sums = running_total(df, ["hot", "id"], "n", "upto", partitions).orderBy("hot", "id")
    assert [r["upto"] for r in sums.collect()] == list(range(2, 4_002, 2))


def test_lookups(spark):
    countries = spark.createDataFrame([(3, "abc", "Late"), (1, " ABC", "Early "), (2, "NA", "x"), (4, "d", None), (5, "e", "N/A")],
                                      "row_id LONG, ISO_SOV1 STRING, SOVEREIGN1 STRING")
    assert rows(t.country_lookup(countries)) == [("ABC", "Early")]
    seas = spark.createDataFrame([(30, "B"), (10, "C"), (20, "B"), (40, "A")], "row_id LONG, name STRING")
    assert rows(t.sea_lookup(seas)) == [(0, "C"), (1, "B"), (2, "A")]
    with pytest.raises(KeyError):
        t.country_lookup(seas)
    with pytest.raises(KeyError):
        t.sea_lookup(countries)


def test_upserts(spark):
    old = spark.createDataFrame([("A", "a"), ("B", "b")], "iso STRING, name STRING")
    new = spark.createDataFrame([("B", "bb"), ("C", "c")], "iso STRING, name STRING")
    merged = t.upsert_country(old, new)
    assert rows(merged) == [("A", "a"), ("B", "bb"), ("C", "c")]
    assert rows(t.upsert_country(merged, new)) == rows(merged)
    seas = spark.createDataFrame([(0, "x"), (1, "y")], "id INT, name STRING")
    assert rows(t.upsert_sea(seas, seas.limit(0))) == [(0, "x"), (1, "y")]
    with pytest.raises(Exception, match="two ids"):
        t.upsert_sea(seas, spark.createDataFrame([(2, "x")], "id INT, name STRING")).collect()


def test_location_upsert_overwrites_with_nulls(spark):
    old = spark.createDataFrame([(1, "A", 1), (2, "B", 2)], LOCATION)
    new = spark.createDataFrame([(2, None, None), (3, "C", None)], LOCATION)
    merged = t.upsert_location(old, new)
    assert rows(merged) == sorted([(1, "A", 1), (2, None, None), (3, "C", None)], key=str)
    assert rows(t.upsert_location(merged, new)) == rows(merged)


def test_integrity(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k STRING")
    assert rows(t.check_unique(df, "k")) == sorted([("a", 2), (None, 1)], key=str)
    assert rows(t.check_not_null(df, ["k"])) == [(1,)]
    location = spark.createDataFrame([(1, "A", 1), (2, "Z", None), (3, None, 1), (4, "Z", 2)], LOCATION)
    assert rows(t.check_references(location, "country_iso", spark.createDataFrame([("A",)], "iso STRING"), "iso")) == [("Z", 2)]
    gone = spark.createDataFrame([(1,), (9,)], "id LONG")
    assert [r[0] for r in rows(t.delete_cascade(location, gone))] == [2, 3, 4]
    cleared = t.delete_set_null(location, "country_iso", spark.createDataFrame([("Z",), ("Z",)], "iso STRING"), "iso")
    assert rows(cleared) == sorted([(1, "A", 1), (2, None, None), (3, None, 1), (4, None, 2)], key=str)


def test_store_loads_once_and_survives_a_repeat(spark, tmp_path):
    path = str(tmp_path / "quakes")
    assert store.scan_quake(spark, path).isEmpty()
    first = events(spark, {"usgs_id": "a"}, {"usgs_id": "a", "mag": 9.0, "time_utc": datetime(2024, 1, 2)},
                   {"usgs_id": "b", "time_utc": datetime(2024, 2, 1)}, {"usgs_id": None}).drop("id")
    assert store.load_batch(spark, path, first, ["time_utc"], "one") == (4, 3)
    second = events(spark, {"usgs_id": "b", "mag": 5.0}, {"usgs_id": "c", "time_utc": None}).drop("id")
    assert store.load_batch(spark, path, second, ["time_utc"], "two") == (2, 1)
    assert store.load_batch(spark, path, second, ["time_utc"], "two") == (2, 1)     # the same load again
    stored = store.scan_quake(spark, path)
    assert [r["usgs_id"] for r in stored.orderBy("id").collect()].count(None) == 1
    assert rows(stored.select("usgs_id", "mag").where("usgs_id IS NOT NULL")) == [("a", 1.0), ("b", 1.0), ("c", 1.0)]
    assert sorted(r["id"] for r in stored.collect()) == [0, 1, 2, 3]
    january = EventFilter(start=datetime(2024, 1, 1), end=datetime(2024, 1, 31)).apply(stored)
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "event_month" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert {r["usgs_id"] for r in january.collect()} == {"a", None}


def test_load_log_keeps_real_counts(spark, tmp_path):
    path = str(tmp_path / "log")
    assert store.read_load_log(spark, path).isEmpty()
    for submitted, inserted, status in ((4, 3, "success"), (0, 0, "error")):
        store.append_load_log(spark, path, "s", datetime(2024, 1, 1), datetime(2024, 1, 2), submitted, inserted, status, datetime(2024, 1, 3))
    assert rows(store.read_load_log(spark, path).select("rows_submitted", "rows_inserted", "status")) == [(0, 0, "error"), (4, 3, "success")]


def test_location_table_rewrites_only_touched_blocks(spark, tmp_path):
    path = str(tmp_path / "location")
    far = store.LOCATION_BLOCK * 3
    store.write_location(spark, path, spark.createDataFrame([(1, "A", 1), (far, "B", 2)], LOCATION))
    untouched = sorted(p.name for p in (tmp_path / "location" / "id_block=3").iterdir())
    store.write_location(spark, path, spark.createDataFrame([(1, None, None), (2, "C", 1)], LOCATION))
    assert rows(store.read_location(spark, path)) == sorted([(1, None, None), (2, "C", 1), (far, "B", 2)], key=str)
    assert sorted(p.name for p in (tmp_path / "location" / "id_block=3").iterdir()) == untouched
    points = spark.createDataFrame([(2,), (5,)], "id LONG")
    assert rows(t.unresolved_points(points, store.read_location(spark, path))) == [(5,)]


def test_unresolved_points_by_blocks_equal_an_anti_join(spark):
    points = spark.range(40).where("id NOT IN (7, 33)")
    located = spark.range(45).where("id NOT IN (12, 13, 21)").select(F.col("id").alias("quake_id"))     # block 2 has as many ids as points
    for max_copied in (100, 0):
        for size in (1, 10, 1000):
            assert rows(t.unresolved_points(points, located, size, max_copied)) == [(12,), (13,), (21,)]


def test_a_repeated_load_replaces_all_months_and_keeps_ids(spark, tmp_path):
    path = str(tmp_path / "quakes")
    ids = lambda: {r["usgs_id"]: (r["id"], r["time_utc"].month) for r in store.scan_quake(spark, path).collect()}
    load = lambda name, *changes: store.load_batch(spark, path, events(spark, *changes).drop("id"), ["time_utc"], name)
    january, february = datetime(2024, 1, 31), datetime(2024, 2, 1)
    load("A", {"usgs_id": "x", "time_utc": january}, {"usgs_id": "y", "time_utc": january})
    load("B", {"usgs_id": "z", "time_utc": february})
    before = ids()
    load("A", {"usgs_id": "x", "time_utc": january}, {"usgs_id": "y", "time_utc": january})
    assert ids() == before                                                    # A, B, A
    assert load("A", {"usgs_id": "x", "time_utc": february}, {"usgs_id": "z", "time_utc": january}, {"usgs_id": "n", "time_utc": january}) == (3, 2)
    after = ids()
    assert after["x"] == (before["x"][0], 2) and after["z"] == before["z"] and set(after) == {"x", "z", "n"}
    assert after["n"][0] not in {i for i, _ in before.values()}
    assert not [p.name for p in (tmp_path / "quakes").iterdir() if p.name.startswith("_load")]


def test_a_repeated_load_replaces_its_log(spark, tmp_path):
    path = str(tmp_path / "log")
    for submitted, load_id in ((4, "A"), (5, "B"), (6, "A")):
        store.append_load_log(spark, path, "s", datetime(2024, 1, 1), datetime(2024, 1, 2), submitted, 0, "success", datetime(2024, 1, 3), load_id)
    assert rows(store.read_load_log(spark, path).select("rows_submitted")) == [(5,), (6,)]


def test_stages_go_with_their_owner(spark, tmp_path):
    from tremorlake.session import checkpoint_dir, owned_stages, stage
    files = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    listed = lambda: {str(f.getPath()) for f in files.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(files) if "stage-" in str(f.getPath())}
    before = listed()
    store.load_batch(spark, str(tmp_path / "quakes"), events(spark, {"usgs_id": "x"}).drop("id"), ["time_utc"], "A")
    assert listed() == before
    with owned_stages(spark):
        kept = stage(spark.range(3))
        assert kept.count() == 3 and len(listed()) == len(before) + 1
    assert listed() == before


def test_insert_beside_stored_rows_that_differ(spark):
    stored = spark.createDataFrame([(f"k{n}", n) for n in range(0, 600, 2)], "usgs_id STRING, id INT")
    batch = spark.createDataFrame([(f"k{n}", 1000 + n) for n in range(600)] + [(f"k{n}", 5000 + n) for n in range(600)], "usgs_id STRING, id INT")
    assert rows(t.insert_new(stored, batch)) == sorted([(f"k{n}", 1000 + n) for n in range(1, 600, 2)], key=str)


def test_a_sea_without_a_name_is_no_sea(spark):
    layer = spark.sql("SELECT CAST(id AS LONG) row_id, 4326 srid, CAST(array() AS ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>) rings, name "
                      "FROM VALUES (1, null), (2, 'B'), (3, 'A') AS v(id, name)")
    assert rows(t.sea_lookup(layer)) == [(0, "B"), (1, "A")]


def test_a_side_of_many_megabytes_is_not_copied_through_the_driver(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    for n, copied in ((1_000, True), (1_000_000, False)):
        right = spark.range(n).select(F.col("id").alias("k"), F.lit(1).alias("a"), F.lit(2).alias("b"))
        joined = lookup_join(left, right, ["k"])
        assert ("BroadcastHashJoin" in joined._jdf.queryExecution().sparkPlan().toString()) == copied
        assert joined.where("a = 1").count() == 1000
