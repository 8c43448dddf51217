"""The live feed as a stream: windows by offset, restarts in the middle, failing and refused windows."""

from datetime import datetime, timedelta

import pytest

from tremorlake.sources import live, store
from tremorlake.sources.feed import TooManyEvents
from tremorlake.streaming import jobs

START = datetime(2024, 1, 1)


def make_feed(folder, cap=100):
    """One event every ten minutes. Every window asked for is noted; hour 4 is down until ``up`` is there."""
    (folder / "asked").mkdir()

    def fetch(start, end):
        import uuid
        from datetime import datetime, timedelta

        if start <= datetime(2024, 1, 1, 4) < end and not (folder / "up").exists():
            raise RuntimeError("down")
        times = [datetime(2024, 1, 1) + timedelta(minutes=10 * n) for n in range(6 * 24) if start <= datetime(2024, 1, 1) + timedelta(minutes=10 * n) < end]
        if len(times) > cap:
            raise TooManyEvents("too many")
        (folder / "asked" / uuid.uuid4().hex).write_text(f"{start.isoformat()} {end.isoformat()}")
        return ['{"id": "%s", "geometry": {"coordinates": [1.0, 2.0, 3.0]}, "properties": {"mag": 1.0, "time": %d}}' % (
            t.isoformat(), (t - datetime(1970, 1, 1)).total_seconds() * 1000) for t in times]

    def clock():
        from datetime import datetime

        return datetime.fromisoformat((folder / "now").read_text())

    return fetch, clock


def asked(folder):
    spans = sorted(tuple(map(datetime.fromisoformat, p.read_text().split())) for p in (folder / "asked").iterdir())
    assert all(b[0] >= a[1] for a, b in zip(spans, spans[1:]))
    return spans


def test_a_restart_loses_and_repeats_nothing(spark, tmp_path):
    fetch, clock = make_feed(tmp_path)
    spark.dataSource.register(live.live_source("live_feed", fetch, clock))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(now):
        (tmp_path / "now").write_text(now.isoformat())
        query = jobs.start_append(live.stream_live(spark, "live_feed", START, seconds=3600, delay=300), out, checkpoint)
        query.awaitTermination()

    run(START + timedelta(hours=3, minutes=20))
    assert len(asked(tmp_path)) == 3
    with pytest.raises(Exception, match="down"):
        run(START + timedelta(hours=6, minutes=4))       # the window of hour 5 is not old enough
    (tmp_path / "up").write_text("")
    done = {b for _, b in asked(tmp_path)}
    run(START + timedelta(hours=8, minutes=30))         # the batch that failed, with its own windows
    run(START + timedelta(hours=8, minutes=30))
    got = [r["usgs_id"] for r in spark.read.parquet(out).collect()]
    assert sorted(got) == [(START + timedelta(minutes=10 * n)).isoformat() for n in range(48)]
    run(START + timedelta(hours=8, minutes=59))
    assert spark.read.parquet(out).count() == 48 and START + timedelta(hours=3) in done


def test_refused_windows_are_halved_and_events_reach_the_store(spark, tmp_path):
    fetch, clock = make_feed(tmp_path, cap=4)
    (tmp_path / "up").write_text("")
    (tmp_path / "now").write_text((START + timedelta(hours=5)).isoformat())
    spark.dataSource.register(live.live_source("live_store", fetch, clock))
    path = str(tmp_path / "store")
    query = jobs.start_insert_new(live.stream_live(spark, "live_store", START, seconds=7200), path, str(tmp_path / "checkpoint"), ["time_utc"])
    query.awaitTermination()
    assert store.scan_quake(spark, path).count() == 24 and len(asked(tmp_path)) > 4
    assert asked(tmp_path)[-1][1] == START + timedelta(hours=4)


def test_long_pauses_make_wider_windows(tmp_path):
    fetch, clock = make_feed(tmp_path)
    reader = live.live_source("x", fetch, clock)({"start": START.isoformat(), "seconds": "1"}).streamReader(None)
    first = reader.initialOffset()
    parts = reader.partitions(first, {"second": first["second"] + 35_001})
    assert len(parts) <= 10_000 and parts[0].start == first["second"] and parts[-1].end == first["second"] + 35_001
    assert all(a.end == b.start for a, b in zip(parts, parts[1:])) and reader.partitions(first, first) == []
    with pytest.raises(ValueError):
        live.live_source("x", fetch, clock)({"start": START.isoformat(), "seconds": "0"}).streamReader(None)
