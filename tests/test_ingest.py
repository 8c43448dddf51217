"""A first load with a failing window and repeats, its log, its gaps, and locations of what is new."""

from datetime import datetime, timedelta

from tremorlake.operators.load_windows import coverage_gaps
from tremorlake.operators.pip import build_index
from tremorlake.operators.tables import fill_all
from tremorlake.schema import COUNTRY, SEA
from tremorlake.sources import ingest, store

NOW = datetime(2024, 1, 4, 0, 0, 0, 123)
LAYER = "row_id LONG, srid INT, rings ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>"


def make_service(first):
    """One event per day and a second, shared one; the second day is down."""
    def service(start, end):
        day = (start - first).days
        if day == 1:
            raise RuntimeError("down")
        feature = '{"id": %s, "geometry": {"coordinates": [%f, 1.0, 5.0]}, "properties": {"mag": %d.0, "time": %d}}'
        ms = int((start - first.replace(year=1970)).total_seconds() * 1000) + 1
        return [feature % (f'"day{day}"', 1.0 + day, day, ms), feature % ('"shared"', 30.0, day, ms), feature % ("null", 30.0, day, ms)]

    return service


def test_first_load_and_locations(spark, tmp_path):
    quakes, log, location = (str(tmp_path / n) for n in ("quakes", "log", "location"))
    service = make_service(datetime(2024, 1, 1))
    assert ingest.load_recent(spark, quakes, log, service, "feed", NOW, days=3) == (6, 5)
    assert ingest.load_recent(spark, quakes, log, service, "feed", NOW, days=3) == (0, 0)      # no longer empty
    stored = store.scan_quake(spark, quakes)
    assert sorted((r["usgs_id"] or "", r["mag"]) for r in stored.collect()) == [
        ("", 0.0), ("", 2.0), ("day0", 0.0), ("day2", 2.0), ("shared", 0.0)]
    entries = store.read_load_log(spark, log)
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    assert sorted((r["start_time_utc"], r["rows_submitted"], r["rows_inserted"], r["status"]) for r in entries.collect()) == [
        (day(0), 3, 3, "success"), (day(1), 0, 0, "error"), (day(2), 3, 2, "success")]
    assert [(r["gap_start"], r["gap_end"]) for r in coverage_gaps(entries).collect()] == [(day(1), day(2))]

    square = [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]]
    countries = spark.createDataFrame([(1, 4326, square, "abc", "Abc")], LAYER + ", ISO_SOV1 STRING, SOVEREIGN1 STRING")
    basins = spark.createDataFrame([(9, 4326, [[(x + 1, y) for x, y in square[0]]], "Sea")], LAYER + ", name STRING")
    names, seas = fill_all(spark.createDataFrame([], COUNTRY), spark.createDataFrame([], SEA), countries, basins)
    assert [tuple(r) for r in names.collect()] == [("ABC", "Abc")]

    def locate():
        ingest.locate_new(spark, quakes, location, build_index(countries), countries, build_index(basins), basins, seas)
        found = store.read_location(spark, location).join(stored.withColumnRenamed("id", "quake_id"), "quake_id")
        return sorted((r["usgs_id"] or "", r["country_iso"], r["sea_id"]) for r in found.collect() if r["usgs_id"])

    want = [("day0", "ABC", 0), ("day2", None, 0), ("shared", None, None)]
    assert locate() == want
    assert locate() == want         # nothing new: the same table


def test_a_year_is_loaded_month_by_month(spark, tmp_path):
    """Half-open windows: the last second of a month is asked for, and a refused month is split."""
    def service(start, end):
        from tremorlake.sources.feed import TooManyEvents
        if end - start > timedelta(days=20):
            raise TooManyEvents("month")
        last = datetime(2023, 1, 31, 23, 59, 59)
        ms = int((last - datetime(1970, 1, 1)).total_seconds() * 1000)
        return ['{"id": "e", "properties": {"mag": 1.0, "time": %d}}' % ms] if start <= last < end else []

    quakes, log = str(tmp_path / "quakes"), str(tmp_path / "log")
    for _ in range(2):
        assert ingest.load_year(spark, quakes, log, service, "feed", NOW) == (1, 1)
        entries = store.read_load_log(spark, log)
        assert entries.count() == 24 and coverage_gaps(entries).isEmpty()
        assert [r["usgs_id"] for r in store.scan_quake(spark, quakes).collect()] == ["e"]
