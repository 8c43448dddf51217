"""Parallel fetch: windows, failures, the source interface."""

from datetime import datetime, timedelta

import pytest

from tremorlake.operators.features import flatten_feature
from tremorlake.sources import feed

START = datetime(2024, 1, 1)


def make_service():
    """Two features per hour; the third hour is broken."""
    broken = START + timedelta(hours=2)

    def service(start, end):
        if start == broken:
            raise RuntimeError("down")
        return ['{"id": "%s-%d", "properties": {"mag": 1.0}}' % (start.isoformat(), i) for i in range(2)]

    return service


def check(fetched):
    log = {r["start_time_utc"]: (r["rows_submitted"], r["status"]) for r in feed.fetch_log(fetched, "s").collect()}
    assert log == {START + timedelta(hours=h): ((0, "error") if h == 2 else (2, "success")) for h in range(4)}
    got = flatten_feature(feed.fetched_features(fetched)).collect()
    assert len({r["usgs_id"] for r in got}) == 6 and all(r["lon"] is None for r in got)
    assert [r["message"] for r in fetched.where("status = 'error'").collect()] == ["down"]


def test_fetch_of_a_window_table(spark):
    windows = spark.createDataFrame([(START + timedelta(hours=h), START + timedelta(hours=h + 1)) for h in range(4)],
                                    "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ")
    check(feed.fetch_windows(windows, make_service(), 4))


def test_fetch_as_a_source(spark):
    spark.dataSource.register(feed.feed_source("event_feed", make_service()))
    reader = spark.read.format("event_feed").option("start", START.isoformat()).option("end", (START + timedelta(hours=4)).isoformat())
    df = reader.option("seconds", 3600).load()
    assert df.rdd.getNumPartitions() == 4
    check(df)
    listed = f'[["{START.isoformat()}", "{(START + timedelta(hours=1)).isoformat()}"]]'
    assert spark.read.format("event_feed").option("windows", listed).load().where("status = 'feature'").count() == 2
    with pytest.raises(Exception, match="too many windows"):
        reader.option("seconds", 1).load().collect()


def test_union_keeps_repeats(spark):
    a = spark.range(2)
    assert feed.union_fetches([a, a]).count() == 4


def refusing(cap):
    """One event per second; refuses windows with more than ``cap`` events, and second 7 holds ten of them."""
    def service(start, end):
        from tremorlake.sources.feed import TooManyEvents
        seconds = [int((start - START).total_seconds()) + k for k in range(int((end - start).total_seconds()))]
        events = [s for s in seconds for _ in range(10 if s == 7 else 1)]
        if len(events) > cap:
            raise TooManyEvents(f"{len(events)} events")
        return ['{"id": "%d", "properties": {"mag": 1.0}}' % s for s in events]

    return service


@pytest.mark.parametrize("cap", [4, 12, 1000])
def test_a_refused_window_is_split_where_it_is_fetched(spark, cap):
    windows = spark.createDataFrame([(START, START + timedelta(seconds=37)), (START + timedelta(seconds=37), START + timedelta(seconds=40))],
                                    "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ")
    fetched = feed.fetch_windows(windows, refusing(cap), 2).cache()
    log = sorted((r["start_time_utc"], r["end_time_utc"], r["rows_submitted"], r["status"]) for r in feed.fetch_log(fetched, "s").collect())
    assert log[0][0] == START and log[-1][1] == START + timedelta(seconds=40)
    assert all(a[1] == b[0] for a, b in zip(log, log[1:])) and all(n <= cap for _, _, n, _ in log)
    over = [r for r in log if r[3] != "success"]
    second = START + timedelta(seconds=7)
    assert over == ([(second, second + timedelta(seconds=1), 0, "over_cap")] if cap < 10 else [])
    got = [int(r["usgs_id"]) for r in flatten_feature(feed.fetched_features(fetched)).collect()]
    assert sorted(got) == sorted(s for s in range(40) for _ in range(10 if s == 7 else 1) if cap >= 10 or s != 7)
    fetched.unpersist()


def test_texts_that_are_no_feature_are_told(spark):
    def service(start, end):
        return ["<html>busy</html>", '{"id": "a", "properties": {"mag": 1.0}}', '{"id": "b", "prop', "{}"]

    windows = spark.createDataFrame([(START, START + timedelta(hours=1))], "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ")
    fetched = feed.fetch_windows(windows, service, 1)
    assert [(r["rows_submitted"], r["status"]) for r in feed.fetch_log(fetched, "s").collect()] == [(1, "partial")]
    assert [r["usgs_id"] for r in flatten_feature(feed.fetched_features(fetched)).collect()] == ["a"]


def test_landed_texts_and_documents_that_are_broken(spark, tmp_path):
    from tremorlake.operators.filters import EventFilter
    from tremorlake.sources import geojson, registry
    (tmp_path / "lines").mkdir()
    old = '{"id": "a", "geometry": {"coordinates": [1, 2, 3]}, "properties": {"mag": 1.0, "time": 1704100000000, "updated": 1}}'
    new = old.replace('"updated": 1', '"updated": 2').replace('"mag": 1.0', '"mag": 2.0')
    (tmp_path / "lines" / "x.txt").write_text("\n".join([old, "<html>busy</html>", "", '{"id": "b", "prop', new]))
    path = str(tmp_path / "lines")
    assert [r["value"] for r in geojson.unreadable_lines(spark, path).collect()] == ["<html>busy</html>", '{"id": "b", "prop']
    answer = registry.answer(spark, "landed", path, EventFilter(start=datetime(2024, 1, 1), end=datetime(2024, 2, 1))).collect()
    assert [r["mag"] for r in answer] == [2.0] and isinstance(answer[0]["id"], int)
    (tmp_path / "bad.json").write_text("<html>busy</html>")
    with pytest.raises(Exception):
        geojson.read_geojson_features(spark, str(tmp_path / "bad.json")).collect()
