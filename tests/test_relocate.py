"""After a change of the polygon layers only events in changed cells are resolved and only changed rows are written."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from tremorlake.operators.enrich import location_rows, points_to_relocate, resolve_location, scan_points
from tremorlake.operators.pip import build_index
from tremorlake.operators.tables import sea_lookup
from tremorlake.sources import ingest, store
from test_functions import events
from test_pip import LAYER

SQUARE = lambda x, y, w=4.0: [[(x, y), (x + w, y), (x + w, y + w), (x, y + w)]]


def country(spark, *shapes):
    rows = [(i, 4326, rings, iso, iso.title()) for i, rings, iso in shapes]
    layer = spark.createDataFrame(rows, LAYER + ", ISO_SOV1 STRING, SOVEREIGN1 STRING")
    return build_index(layer), layer


def sea(spark, *shapes):
    layer = spark.createDataFrame([(i, 4326, rings, name) for i, rings, name in shapes], LAYER + ", name STRING")
    return build_index(layer), layer, sea_lookup(layer)


def test_only_what_a_change_touches_is_resolved_and_written(spark, tmp_path):
    rng, quakes, path = random.Random(2), str(tmp_path / "quakes"), str(tmp_path / "location")
    batch = [{"usgs_id": f"e{n}", "lon": rng.uniform(-60, 60), "lat": rng.uniform(-40, 40), "time_utc": datetime(2024, 1, 1)} for n in range(600)]
    store.load_batch(spark, quakes, events(spark, *batch).drop("id"), ["time_utc"], "one")
    still = [(1, SQUARE(-50.0, -30.0, 20.0), "AA"), (2, SQUARE(-50.0, 10.0, 20.0), "BB")]
    old = country(spark, *still, (3, SQUARE(10.0, 0.0, 9.0), "CC"), (4, SQUARE(30.0, 0.0, 9.0), "DD"))
    # moved, gone, renamed, and new row ids in the same order for the rest
    new = country(spark, (11, still[0][1], "AA"), (12, still[1][1], "BX"), (13, SQUARE(13.0, 2.0, 9.0), "CC"))
    seas = sea(spark, (5, SQUARE(-60.0, -40.0, 55.0), "West"), (6, SQUARE(0.0, -40.0, 60.0), "East"))
    points = scan_points(store.scan_quake(spark, quakes))
    store.write_location(spark, path, location_rows(resolve_location(points, *old, *seas)))
    before = {r["quake_id"]: r for r in store.read_location(spark, path).collect()}
    want = {r["quake_id"]: r for r in location_rows(resolve_location(points, *new, *seas)).collect()}
    touched = {r["id"] for r in points_to_relocate(points, old, new, seas, seas).collect()}
    differ = {i for i in want if want[i] != before[i]}
    assert differ and differ <= touched and len(touched) < 300
    assert {i for i in want if before[i]["country_iso"] == "AA"}.isdisjoint(touched)
    assert ingest.relocate_changed(spark, quakes, path, old, new, seas, seas) == len(differ)
    assert {r["quake_id"]: r for r in store.read_location(spark, path).collect()} == want
    files = sorted(p.name for p in (tmp_path / "location").rglob("*.parquet"))
    assert ingest.relocate_changed(spark, quakes, path, new, new, seas, seas) == 0
    assert sorted(p.name for p in (tmp_path / "location").rglob("*.parquet")) == files


def test_changes_of_seas_and_cells_of_several_sizes(spark):
    """Indexes cut to different depths; sea ids follow the id table."""
    rng = random.Random(4)
    fan = [(i, [[(0.0, 0.0), (20.0, i * 1.0), (20.0, i + 0.7)]], f"C{i}") for i in range(12)]
    layers = [[s for s in fan if s[0] != skip] for skip in (5, 7)]
    sides = []
    for shapes in layers:
        layer = country(spark, *shapes)[1]
        sides.append((build_index(layer, split_entries=14), layer))
    sea_sides = sea(spark, (1, SQUARE(0.0, 0.0, 10.0), "N")), sea(spark, (1, SQUARE(0.0, 0.0, 10.0), "N"), (0, SQUARE(30.0, 0.0), "A"))
    assert sides[0][0].levels > 1
    points = spark.createDataFrame([(n, rng.uniform(-1, 34), rng.uniform(-1, 14)) for n in range(500)], "id LONG, lon DOUBLE, lat DOUBLE")
    answers = [{r["quake_id"]: tuple(r) for r in location_rows(resolve_location(points, *c, *s)).collect()} for c, s in zip(sides, sea_sides)]
    differ = {i for i in answers[0] if answers[0][i] != answers[1][i]}
    touched = {r["id"] for r in points_to_relocate(points, *sides, *sea_sides).collect()}
    assert differ and differ <= touched
    # the sea kept its place but has another id now, so all its points are touched
    assert {i for i, row in answers[0].items() if row[2] is not None} <= touched
    far = {r["id"] for r in points.where("lon > 25 AND lat > 9").collect()}
    assert far.isdisjoint(touched)
