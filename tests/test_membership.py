"""Key filters of folders: no key is missed, few foreign ones are taken for possible, other folders stay closed."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tremorlake.operators.membership import key_filters, possible_folders
from tremorlake.sources import store
from tremorlake.streaming import jobs
from test_functions import events
from test_streaming import at, land, run, stream


def test_no_key_is_missed_and_few_are_guessed(spark):
    sizes = {"a": 1, "b": 50, "c": 3000, "d": 20_000}
    rows = spark.range(sum(sizes.values())).select(F.concat(F.lit("k"), "id").alias("key"), F.expr(
        "CASE WHEN id < 1 THEN 'a' WHEN id < 51 THEN 'b' WHEN id < 3051 THEN 'c' ELSE 'd' END").alias("folder"))
    filters = key_filters(rows.unionByName(spark.createDataFrame([(None, "e")], "key STRING, folder STRING")), F.col("key"), ["folder"])
    assert {r["folder"]: r["blocks"] for r in filters.collect()} == {"a": 1, "b": 1, "c": 2, "d": 8}
    for max_copied in (1 << 20, 0):
        for folder in sizes:
            found = possible_folders(filters, rows.where(F.col("folder") == folder), "key", ["folder"], max_copied)
            assert folder in {r["folder"] for r in found.collect()}
    foreign = spark.range(3000).select(F.concat(F.lit("x"), "id").alias("key"))
    hits = sum((possible_folders(filters.where("folder = 'd'"), foreign.where(F.col("key") == f"x{i}"), "key", ["folder"]).count() for i in range(8)))
    assert hits <= 2
    assert possible_folders(filters, foreign.where("false"), "key", ["folder"]).count() == 0
    assert possible_folders(filters.where("false"), foreign, "key", ["folder"]).count() == 0


def test_loads_equal_an_anti_join_on_random_ids(spark, tmp_path):
    rng, path, known = random.Random(6), str(tmp_path / "store"), {}
    for n in range(5):
        batch = [{"usgs_id": f"e{rng.randrange(120)}", "mag": float(n), "time_utc": datetime(2024, 1, 1) + timedelta(days=rng.randrange(90))} for _ in range(40)]
        before = set(known)
        for e in sorted(batch, key=lambda e: e["time_utc"]):
            known.setdefault(e["usgs_id"], (e["mag"], e["time_utc"]))
        counts = store.load_batch(spark, path, events(spark, *batch).drop("id"), ["time_utc"], f"load{n}")
        assert counts == (40, len(set(known) - before))
    assert {r["usgs_id"]: r["mag"] for r in store.scan_quake(spark, path).collect()} == {k: v[0] for k, v in known.items()}
    ids = [r["id"] for r in store.scan_quake(spark, path).collect()]
    assert sorted(ids) == list(range(len(known)))


def test_folders_without_hits_are_not_read(spark, tmp_path):
    """A broken file in a folder that cannot hold the batch's ids does no harm; a store without filters is read whole."""
    path = tmp_path / "store"
    for month in (1, 2, 3):
        store.load_batch(spark, str(path), events(spark, *[{"usgs_id": f"m{month}-{i}", "time_utc": datetime(2024, month, 1)} for i in range(20)]).drop("id"),
                         ["time_utc"], f"load{month}")
    broken = next((path / "load_id=load2").rglob("*.parquet"))
    good = broken.read_bytes()
    broken.write_bytes(b"no parquet")
    for checksum in broken.parent.glob(".*.crc"):
        checksum.unlink()
    folders, top = store.folders_to_open(spark, str(path), spark.createDataFrame([("m1-3",)], "k STRING"), "k")
    assert folders == ["load_id=load1/event_month=2024-01"] and top == 59
    batch = events(spark, {"usgs_id": "m1-3"}, {"usgs_id": "new", "time_utc": datetime(2024, 1, 9)}).drop("id")
    assert store.load_batch(spark, str(path), batch, ["time_utc"], "load4") == (2, 1)
    broken.write_bytes(good)
    rows = store.scan_quake(spark, str(path))
    assert rows.count() == 61 and rows.where("usgs_id = 'new'").first()["id"] == 60
    store.delete_path(spark, f"{path}/{store.MEMBERS}")
    assert len(store.folders_to_open(spark, str(path), spark.createDataFrame([("zzz",)], "k STRING"), "k")[0]) == 4
    assert store.load_batch(spark, str(path), batch, ["time_utc"], "load5") == (2, 0)


def test_streams_into_one_store_keep_each_others_events(spark, tmp_path):
    path = str(tmp_path / "store")
    ids = lambda: sorted(r["usgs_id"] or "-" for r in store.scan_quake(spark, path).collect())
    for name, hours in (("a", range(5)), ("b", range(100, 105))):
        for h in hours:
            land(spark, str(tmp_path / name), at(h))
        run(jobs.start_insert_new(stream(spark, str(tmp_path / name)), path, str(tmp_path / f"progress-{name}"), ["time_utc"]))
    assert ids() == sorted(f"e{h}" for h in [*range(5), *range(100, 105)])
    # two batches of one stream may hold equal events without an id; a stream that replays them stores them once
    land(spark, str(tmp_path / "a"), {"usgs_id": None}, {"usgs_id": None})
    land(spark, str(tmp_path / "a"), {"usgs_id": None})
    run(jobs.start_insert_new(stream(spark, str(tmp_path / "a")), path, str(tmp_path / "progress-a"), ["time_utc"]))
    assert ids().count("-") == 3 and len(ids()) == 13
    run(jobs.start_insert_new(stream(spark, str(tmp_path / "a")), path, str(tmp_path / "lost"), ["time_utc"]))
    assert ids().count("-") == 3 and len(ids()) == 13
    assert len({r["id"] for r in store.scan_quake(spark, path).collect()}) == 13


def test_a_retried_batch_replaces_its_own_rows(spark, tmp_path):
    path, first = str(tmp_path / "store"), events(spark, {"usgs_id": "x"}, {"usgs_id": None}).drop("id")
    for name in ("stream-1-0", "stream-1-1", "stream-1-0"):
        store.load_batch(spark, path, first, ["time_utc"], name, replayed_from="stream-1-")
    kept = store.scan_quake(spark, path)
    assert sorted((r["usgs_id"] or "-", r["load_id"]) for r in kept.collect()) == [("-", "stream-1-0"), ("-", "stream-1-1"), ("x", "stream-1-0")]
