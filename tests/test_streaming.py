"""Streams over several landed files: repeats, late data, restarts; equal to the batch answer."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tremorlake.operators.proximity import last_within_km, near_places, places_near_events
from tremorlake.sources.geojson import land_feed_snapshot
from tremorlake.sources.store import scan_quake
from tremorlake.streaming import jobs
from test_functions import events

DAY = datetime(2024, 1, 1)


def land(spark, path, *batch):
    land_feed_snapshot(events(spark, *batch).coalesce(1), path)


def at(hours, **more):
    return {"usgs_id": f"e{hours}", "time_utc": DAY + timedelta(hours=hours), **more}


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def stream(spark, path):
    return jobs.stream_features(spark, path, max_files=1)


def test_counts_over_batches_drop_late_rows(spark, tmp_path):
    feed, out, progress = str(tmp_path / "feed"), str(tmp_path / "out"), str(tmp_path / "progress")
    land(spark, feed, at(0), at(0.5), at(1))
    run(jobs.start_updates(jobs.stream_counts(stream(spark, feed), delay="2 hours"), out, progress))
    land(spark, feed, at(1.5), at(10))
    run(jobs.start_updates(jobs.stream_counts(stream(spark, feed), delay="2 hours"), out, progress))
    land(spark, feed, at(0.2), at(9.5))        # the first is later than the watermark of 8 hours
    run(jobs.start_updates(jobs.stream_counts(stream(spark, feed), delay="2 hours"), out, progress))
    counts = jobs.latest_updates(spark.read.parquet(out), ["window_start", "window_end"])
    assert {(r["window_start"].hour, r["n_events"]) for r in counts.collect()} == {(0, 2), (1, 2), (10, 1), (9, 1)}


def test_updates_are_merged_and_a_retried_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    merge = lambda updates: jobs.latest_updates(updates, ["k"])
    now = lambda: sorted(tuple(r) for r in merge(spark.read.parquet(out)).collect())
    put = lambda n: jobs._write_update(spark.createDataFrame([(n % 3, n)], "k INT, v INT"), out, n, merge, every=4)
    for n in range(13):
        put(n)
        assert now() == sorted({i % 3: i for i in range(n + 1)}.items())
        assert len(list((tmp_path / "out").glob("batch=*"))) <= 10
    put(12)
    assert now() == [(0, 12), (1, 10), (2, 11)]
    jobs._write_update(spark.createDataFrame([(2, 11)], "k INT, v INT"), out, 11, merge, every=4)      # a merging batch again
    assert now() == [(0, 12), (1, 10), (2, 11)]


def test_sliding_windows(spark, tmp_path):
    land(spark, str(tmp_path / "feed"), at(5))
    sliding = jobs.stream_counts(stream(spark, str(tmp_path / "feed")), "24 hours", "1 hour")
    run(jobs.start_updates(sliding, str(tmp_path / "out"), str(tmp_path / "progress")))
    assert jobs.latest_updates(spark.read.parquet(str(tmp_path / "out")), ["window_start"]).count() == 24


def test_dedup_over_files_and_hot_ids(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    land(spark, feed, *[{"usgs_id": "hot", "mag": float(i)} for i in range(50)], at(1))
    land(spark, feed, {"usgs_id": "hot", "mag": 99.0}, at(1), at(2), {"usgs_id": None}, {"usgs_id": None})
    run(jobs.start_append(jobs.stream_dedup(stream(spark, feed)), out, str(tmp_path / "progress")))
    assert sorted(r["usgs_id"] for r in spark.read.parquet(out).collect()) == ["e1", "e2", "hot"]
    run(jobs.start_append(jobs.stream_without_id(stream(spark, feed)), str(tmp_path / "none"), str(tmp_path / "progress2")))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 2


def test_insert_new_is_idempotent_over_restarts(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "store")
    land(spark, feed, at(1, mag=1.0), at(2), {"usgs_id": None})
    run(jobs.start_insert_new(stream(spark, feed), path, str(tmp_path / "progress"), ["time_utc"]))
    land(spark, feed, at(1, mag=9.0), at(3))
    run(jobs.start_insert_new(stream(spark, feed), path, str(tmp_path / "progress"), ["time_utc"]))
    ids = lambda: sorted((r["usgs_id"] or "", r["mag"]) for r in scan_quake(spark, path).collect())
    want = [("", 1.0), ("e1", 1.0), ("e2", 1.0), ("e3", 1.0)]
    assert ids() == want
    run(jobs.start_insert_new(stream(spark, feed), path, str(tmp_path / "lost"), ["time_utc"]))     # progress lost, all replayed
    assert ids() == want
    assert len({r["id"] for r in scan_quake(spark, path).collect()}) == 4


def test_alerts_once_per_event_and_place(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    places = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.1, 2.0), (3, 90.0, 0.0)], "place INT, lon DOUBLE, lat DOUBLE")
    land(spark, feed, at(1, tsunami=1), at(2, tsunami=0), at(3, tsunami=1, lon=50.0))
    land(spark, feed, at(1, tsunami=1), at(4, tsunami=1))
    run(jobs.start_append(jobs.tsunami_alerts(stream(spark, feed), places, 100.0), out, str(tmp_path / "progress")))
    assert sorted((r["usgs_id"], r["place"]) for r in spark.read.parquet(out).collect()) == [
        ("e1", 1), ("e1", 2), ("e4", 1), ("e4", 2)]


def test_alerts_remember_positions_and_not_places(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    places = spark.createDataFrame([(i, 1.0 + i / 1000, 2.0) for i in range(300)], "place INT, lon DOUBLE, lat DOUBLE")
    land(spark, feed, *[at(i, tsunami=1) for i in range(5)])
    land(spark, feed, at(1, tsunami=1), at(2, tsunami=1, lon=1.01), at(6, tsunami=1, lon=70.0))
    query = jobs.start_append(jobs.tsunami_alerts(stream(spark, feed), places, 100.0), out, str(tmp_path / "progress"))
    run(query)
    got = [(r["usgs_id"], r["place"]) for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) == 5 * 300
    rows = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]
    assert 0 < max(rows) <= 20


def test_alerts_equal_all_pairs_for_moved_and_nameless_events_and_places_listed_twice(spark, tmp_path):
    rng, feed, out = random.Random(5), str(tmp_path / "feed"), str(tmp_path / "out")
    spots = [(i % 50, rng.uniform(-30, 30), rng.uniform(-85, 85)) for i in range(80)] + [(50, 180.0, 0.0), (51, -179.9, 0.0), (3, None, 1.0), (None, 0.0, 0.0)]
    places = spark.createDataFrame(spots + spots[:9], "place INT, lon DOUBLE, lat DOUBLE")
    told = []
    for n in range(3):
        batch = [at(rng.randrange(20), usgs_id=rng.choice([None, *[f"m{k}" for k in range(25)]]), tsunami=rng.choice([0, 1, 1, None]),
                    lon=rng.uniform(-30, 30), lat=rng.uniform(-89, 89)) for _ in range(60)]
        batch += batch[:9] + [at(3, usgs_id="edge", tsunami=1, lon=179.9 - n / 10, lat=0.0), at(4, usgs_id="none", tsunami=1, lon=None),
                              {"usgs_id": f"timeless{n}", "time_utc": None, "tsunami": 1, "lon": spots[0][1], "lat": spots[0][2]}]
        told += batch
        land(spark, feed, *batch)
    run(jobs.start_append(jobs.tsunami_alerts(stream(spark, feed), places, 1200.0), out, str(tmp_path / "progress")))
    got = spark.read.parquet(out)
    assert got.columns == ["usgs_id", "time_utc", "lon", "lat", "place", "km"] and got.where("km > 1200").isEmpty()
    pairs = [(r["usgs_id"] or "", r["place"]) for r in got.collect()]
    near = near_places(events(spark, *told).where("tsunami = 1"), places.where("lon IS NOT NULL"), 1200.0).select("usgs_id", "place").distinct()
    assert sorted(pairs) == sorted((r["usgs_id"] or "", r["place"]) for r in near.collect()) and len(pairs) > 150


def test_alerts_are_forgotten_with_the_watermark_and_far_events_do_not_move_it(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    places = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 2.0)], "place INT, lon DOUBLE, lat DOUBLE")
    moved = lambda hours, **more: at(hours, usgs_id="e", tsunami=1, **more)
    for batch in ([moved(10, lon=1.0)], [moved(10.2, lon=1.5), at(90, tsunami=1, lon=90.0)], [at(20, tsunami=1)], [at(21, tsunami=1)],
                  [moved(22, lon=1.0), at(3, tsunami=1)]):
        land(spark, feed, *batch)
        run(jobs.start_append(jobs.tsunami_alerts(stream(spark, feed), places, 80.0, "1 hour"), out, str(tmp_path / "progress")))
    got = sorted((r["usgs_id"], r["place"], r["time_utc"].hour) for r in spark.read.parquet(out).collect())
    assert got == [("e", 1, 10), ("e", 1, 22), ("e", 2, 10), ("e20", 1, 20), ("e21", 1, 21)]


def test_newest_event_per_place_over_batches(spark, tmp_path):
    feed, out, progress = str(tmp_path / "feed"), str(tmp_path / "out"), str(tmp_path / "progress")
    places = spark.createDataFrame([(1, 1.0, 2.0), (2, 90.0, 0.0)], "place INT, lon DOUBLE, lat DOUBLE")
    for batch in ([at(5)], [at(3)], [at(7), at(8, lon=90.0, lat=0.0)]):
        land(spark, feed, *batch)
        run(jobs.start_last_quake(stream(spark, feed), places, 100.0, out, progress))
    newest = jobs.latest_quake(spark.read.parquet(out))
    assert sorted((r["place"], r["usgs_id"]) for r in newest.collect()) == [(1, "e7"), (2, "e8")]
    assert newest.where(F.col("km") > 100).isEmpty()


def test_state_partitions_are_set_for_the_start_only(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    land(spark, str(tmp_path / "feed"), at(1))
    counts = jobs.stream_counts(stream(spark, str(tmp_path / "feed")))
    with jobs.state_partitions(spark, 3):
        query = jobs.start_updates(counts, str(tmp_path / "out"), str(tmp_path / "progress"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    run(query)
    assert query.lastProgress is None or query.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 3


def test_last_quakes_equal_the_batch_form_and_spread_no_place(spark, tmp_path):
    rng, feed, out, progress = random.Random(8), str(tmp_path / "feed"), str(tmp_path / "out"), str(tmp_path / "progress")
    spots = [(i, rng.uniform(-180, 180), rng.uniform(-89, 89)) for i in range(60)] + [(60, 180.0, 0.0), (61, -180.0, 0.2), (62, 0.0, 90.0), (63, None, 1.0)]
    places = spark.createDataFrame(spots, "place INT, lon DOUBLE, lat DOUBLE")
    all_rows = []
    for n in range(3):
        batch = [at(1 + rng.randrange(20), usgs_id=f"b{n}-{i}", lon=rng.uniform(-180, 180), lat=rng.uniform(-90, 90), mag=1.0) for i in range(80)]
        all_rows += batch
        land(spark, feed, *batch, at(3, usgs_id="none", lon=None))
        run(jobs.start_last_quake(stream(spark, feed), places, 1500.0, out, progress))
    rows = events(spark, *[{**r, "id": i} for i, r in enumerate(all_rows)])
    batch_form = last_within_km(rows.withColumn("id", F.col("usgs_id")), places.where("lon IS NOT NULL"), 1500.0)
    newest = jobs.latest_quake(spark.read.parquet(out))
    answer = lambda df, name: sorted((r["place"], r[name], r["km"]) for r in df.collect())
    assert answer(newest, "usgs_id") == answer(batch_form, "id") and newest.count() > 40
    for max_copied in (1 << 26, 0):
        met = places_near_events(rows, places, 1500.0, max_copied)
        assert sorted(map(tuple, met.select("place", "usgs_id").collect())) == sorted(
            map(tuple, near_places(rows, places.where("lon IS NOT NULL"), 1500.0).select("place", "usgs_id").collect()))
    join = met._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    assert join.count("Generate") == 2 and "Generate" not in join[join.rindex("Relation"):]


def test_newest_events_of_large_and_small_batches_agree(spark, tmp_path):
    rng, feed = random.Random(3), str(tmp_path / "feed")
    places = spark.createDataFrame([(i, rng.uniform(-180, 180), rng.uniform(-85, 85)) for i in range(50)], "place INT, lon DOUBLE, lat DOUBLE")
    for n in range(2):
        land(spark, feed, *[at(rng.randrange(40), usgs_id=f"b{n}-{i}", lon=rng.uniform(-180, 180), lat=rng.uniform(-90, 90)) for i in range(60)])
    answers = []
    for few in (1000, 5):
        out = str(tmp_path / f"out{few}")
        run(jobs.start_last_quake(stream(spark, feed), places, 1500.0, out, str(tmp_path / f"progress{few}"), 2, few))
        answers.append(sorted(map(tuple, jobs.latest_quake(spark.read.parquet(out)).select("place", "usgs_id", "km").collect())))
    assert answers[0] == answers[1] and len(answers[0]) > 20
