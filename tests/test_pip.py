"""Point in polygon: both plans against the plain even-odd test, boundaries, holes and overlaps."""

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tremorlake.operators import pip
from tremorlake.operators.enrich import location_rows, resolve_location
from tremorlake.operators.pip import build_index, choose_cell_deg, covering_pairs, resolve_polygon
from tremorlake.operators.tables import check_references, country_lookup, sea_lookup
from tremorlake.sources.polygons import country_layer, polygon_edges, read_country_polygons, read_sea_polygons, sea_layer, union_layers

LAYER = "row_id LONG, srid INT, rings ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>"


def layer(spark, polygons):
    return spark.createDataFrame([(i, 4326, rings) for i, rings in polygons], LAYER)


def points(spark, coordinates):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(coordinates)], "id LONG, lon DOUBLE, lat DOUBLE")


def covers(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            on_line = (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
            if on_line and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def plain(polygons, coordinates):
    return {i: min((p for p, rings in polygons if covers(rings, x, y)), default=None)
            for i, (x, y) in enumerate(coordinates)}


def answer(df):
    return {r["id"]: r["poly"] for r in df.collect()}


def star(rng, cx, cy, size, corners):
    """A star-shaped ring on a coarse grid, so that corners and edges meet cell borders."""
    turns = sorted(rng.random() * 2 * math.pi for _ in range(corners))
    return [(round((cx + size * rng.uniform(0.2, 1) * math.cos(t)) * 2) / 2,
             round((cy + size * rng.uniform(0.2, 1) * math.sin(t)) * 2) / 2) for t in turns]


@pytest.mark.parametrize("seed, cell", [(1, None), (2, 5.0), (3, 1.0), (4, 0.5)])
def test_both_plans_equal_the_plain_test_on_random_polygons(spark, seed, cell):
    rng = random.Random(seed)
    polygons = [(i, [star(rng, rng.uniform(-40, 40), rng.uniform(-40, 40), rng.choice([3, 12, 30]), rng.randint(4, 40))])
                for i in range(12)]
    coordinates = [(round(rng.uniform(-60, 60) * 2) / 2, round(rng.uniform(-60, 60) * 2) / 2) for _ in range(700)]
    coordinates += [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(700)]
    coordinates += [corner for _, rings in polygons for ring in rings for corner in ring]
    want = plain(polygons, coordinates)
    pts, lay = points(spark, coordinates), layer(spark, polygons)

    index = build_index(lay, cell)
    assert index.cells is not None and index.broadcast
    for chosen in (index, replace(index, broadcast=False), replace(index, cells=None)):
        assert answer(resolve_polygon(pts, chosen)) == want
    pairs = {(r["id"], r["poly"]) for r in covering_pairs(pts, index).collect()}
    assert pairs == {(i, p) for i, (x, y) in enumerate(coordinates) for p, rings in polygons if covers(rings, x, y)}


def test_large_layers_are_measured(spark):
    lay = layer(spark, [(i, [[(i * 1.0, 0.0), (i + 5.0, 0.0), (i + 5.0, 3.0)]]) for i in range(5)])
    assert not build_index(lay, 5.0, max_broadcast_bytes=0).broadcast
    assert build_index(lay, 5.0, max_cell_entries=1).cells is None


def test_boundaries_holes_and_overlaps(spark):
    outer, hole = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]
    polygons = [(7, [outer, hole]), (3, [[(5.0, 5.0), (20.0, 5.0), (20.0, 20.0), (5.0, 20.0)]])]
    coordinates = [(0.0, 0.0), (5.0, 0.0), (4.0, 5.0), (5.0, 4.5), (4.5, 4.5), (8.0, 8.0), (5.0, 5.0), (30.0, 5.0), (2.0, 10.0)]
    index = build_index(layer(spark, polygons))
    got = answer(resolve_polygon(points(spark, coordinates), index))
    assert got == plain(polygons, coordinates)
    assert got[3] is None and got[4] is None        # inside the hole
    assert got[2] == 7                              # on the border of the hole
    assert got[5] == 3                              # in both: the smaller row id


def test_closed_and_open_rings_agree(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    edges = lambda r: {tuple(e) for e in polygon_edges(layer(spark, [(1, [r])])).drop("poly", "ring").collect()}
    assert edges(ring) == edges(ring + ring[:1])


def test_an_empty_layer_covers_nothing(spark):
    index = build_index(layer(spark, []))
    assert answer(resolve_polygon(points(spark, [(1.0, 1.0)]), index)) == {0: None}


def test_points_without_coordinates_stay(spark):
    index = build_index(layer(spark, [(1, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]])]))
    pts = spark.createDataFrame([(1, None, 2.0), (2, 3.0, 1.0)], "id LONG, lon DOUBLE, lat DOUBLE")
    assert answer(resolve_polygon(pts, index)) == {1: None, 2: 1}


def test_the_grid_follows_the_layer(spark):
    big = [(1, [[(-100.0, -50.0), (100.0, -50.0), (100.0, 50.0), (-100.0, 50.0)]])]
    small = [(i, [[(i * 1.0, 0.0), (i + 0.9, 0.0), (i + 0.9, 0.9), (i * 1.0, 0.9)]]) for i in range(100)]
    assert choose_cell_deg(polygon_edges(layer(spark, big))) > choose_cell_deg(polygon_edges(layer(spark, small)))


def test_more_vertices_give_a_finer_grid(spark):
    """Round polygons: the index stays linear in the edges, and the edges one point meets stay bounded."""
    def ring(points, radius):
        at = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda k: F.struct(
            (F.col("id") * 12 - 150 + radius * F.cos(k * 2 * math.pi / points)).alias("x"), (radius * F.sin(k * 2 * math.pi / points)).alias("y")))
        return spark.range(25).select(F.col("id").alias("row_id"), F.lit(4326).alias("srid"), F.array(at).alias("rings"))

    sizes = [choose_cell_deg(polygon_edges(ring(n, 5.0))) for n in (10, 1_000, 20_000, 80_000)]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] <= 0.1        # 2 M edges
    assert choose_cell_deg(polygon_edges(ring(20_000, 0.01))) < 0.001       # many vertices on small shapes
    index = build_index(ring(20_000, 5.0))
    most = index.cells.select(F.max(F.aggregate("cands", F.lit(0), lambda n, c: n + F.size(c["edges"]) + F.size(c["far"])))).first()[0]
    assert most < 2_000 and index.cells.agg(F.sum("entries")).first()[0] < 6 * 25 * 20_000
    pts = points(spark, [(k * 12 - 150 + r, 0.5) for k in range(25) for r in (0.0, 4.9, 5.1)])
    assert answer(resolve_polygon(pts, index)) == {3 * k + j: (k if j < 2 else None) for k in range(25) for j in range(3)}


def test_layers_are_checked(spark):
    bare = layer(spark, [(1, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]])])
    with pytest.raises(KeyError):
        country_layer(bare)
    with pytest.raises(KeyError):
        sea_layer(bare)
    wrong = spark.sql("SELECT 1L AS row_id, 3857 AS srid, 'x' AS name, CAST(array() AS ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>) AS rings")
    with pytest.raises(Exception, match="SRID"):
        sea_layer(wrong).collect()


def test_union_of_files_fills_missing_columns(spark):
    a = spark.sql("SELECT 1L AS row_id, 'x' AS name")
    b = spark.sql("SELECT 2L AS row_id")
    assert {tuple(r) for r in union_layers([a, b]).collect()} == {(1, "x"), (2, None)}


def test_geojson_polygons(spark, tmp_path):
    (tmp_path / "a.geojson").write_text("""{"type": "FeatureCollection", "features": [
      {"type": "Feature", "properties": {"row_id": 4, "ISO_SOV1": "abc", "SOVEREIGN1": "Abc"},
       "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]}},
      {"type": "Feature", "properties": {"row_id": 5, "ISO_SOV1": "xyz", "SOVEREIGN1": "Xyz"},
       "geometry": {"type": "MultiPolygon", "coordinates": [[[[10, 0], [14, 0], [14, 4]]], [[[20, 0], [24, 0], [24, 4]]]]}}]}""")
    lay = read_country_polygons(spark, str(tmp_path / "a.geojson"))
    got = answer(resolve_polygon(points(spark, [(1.0, 1.0), (13.0, 1.0), (23.0, 1.0), (17.0, 1.0)]), build_index(lay)))
    assert got == {0: 4, 1: 5, 2: 5, 3: None}


def test_location_uses_clean_keys_and_sea_ids(spark):
    """Row ids are not sea ids and raw keys are not country keys; references must still hold."""
    square = lambda x: [[(x, 0.0), (x + 4, 0.0), (x + 4, 4.0), (x, 4.0)]]
    countries = spark.createDataFrame([(50, 4326, square(0.0), " abc ", "Abc"), (51, 4326, square(20.0), "NA", "None")],
                                      LAYER + ", ISO_SOV1 STRING, SOVEREIGN1 STRING")
    seas = spark.createDataFrame([(90, 4326, square(2.0), "North"), (95, 4326, square(10.0), "South"), (97, 4326, square(30.0), "North")],
                                 LAYER + ", name STRING")
    lookup = sea_lookup(seas)
    pts = points(spark, [(3.0, 1.0), (11.0, 1.0), (31.0, 1.0), (21.0, 1.0), (60.0, 60.0)])
    found = location_rows(resolve_location(pts, build_index(countries), countries, build_index(seas), seas, lookup))
    assert {tuple(r) for r in found.collect()} == {(0, "ABC", 0), (1, None, 1), (2, None, 0), (3, None, None), (4, None, None)}
    assert check_references(found, "sea_id", lookup, "id").isEmpty()
    assert check_references(found, "country_iso", country_lookup(countries), "iso").isEmpty()


def test_layer_files_as_they_come(spark, tmp_path):
    """Names in any case, the row id under its old name, one feature per line; what is no polygon fails."""
    square = "[[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]"
    feature = '{"type": "Feature", "properties": {"__row_id__": %d, "NAME": "%s"}, "geometry": {"type": "%s", "coordinates": %s}}'
    (tmp_path / "a.geojsonl").write_text("\n".join([feature % (4, "A", "Polygon", square), feature % (5, "B", "MultiPolygon", f"[{square}]")]))
    read = read_sea_polygons(spark, str(tmp_path / "a.geojsonl"))
    assert sorted((r["row_id"], r["name"], len(r["rings"])) for r in read.collect()) == [(4, "A", 1), (5, "B", 1)]
    read.select(F.col("row_id").alias("__row_id__"), "srid", "rings", F.col("name").alias("NAME")).write.parquet(str(tmp_path / "p"))
    assert sorted((r["row_id"], r["name"]) for r in read_sea_polygons(spark, str(tmp_path / "p")).collect()) == [(4, "A"), (5, "B")]
    for kind, coordinates in (("LineString", "[[0, 0], [1, 1]]"), ("Polygon", '"x"')):
        (tmp_path / "bad.geojsonl").write_text(feature % (1, "C", kind, coordinates))
        with pytest.raises(Exception, match="no polygon"):
            read_sea_polygons(spark, str(tmp_path / "bad.geojsonl")).collect()


def test_adaptive_cells_equal_the_plain_test(spark):
    """Random polygons of very different sizes, cut down to a few entries per cell, over both kinds of joins."""
    for seed, most in ((11, 12), (12, 40)):
        rng = random.Random(seed)
        polygons = [(i, [star(rng, rng.uniform(-40, 40), rng.uniform(-40, 40), rng.choice([3, 12, 30]), rng.randint(4, 60))]) for i in range(14)]
        coordinates = [(round(rng.uniform(-60, 60) * 2) / 2, round(rng.uniform(-60, 60) * 2) / 2) for _ in range(400)]
        coordinates += [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(400)]
        coordinates += [corner for _, rings in polygons for ring in rings for corner in ring]
        want, pts = plain(polygons, coordinates), points(spark, coordinates)
        index = build_index(layer(spark, polygons), split_entries=most)
        assert index.levels >= 2 and index.split is not None
        held = index.cells.select(F.max("entries")).first()[0]
        assert held <= most
        for chosen in (index, replace(index, broadcast=False, broadcast_split=False)):
            assert answer(resolve_polygon(pts, chosen)) == want


def test_one_huge_and_many_tiny_detailed_shapes(spark):
    """The huge shape keeps its coarse cells; only the crowded spot is cut, and no cell holds more than its bound."""
    def circle(x, y, radius, n):
        return [[(x + radius * math.cos(2 * math.pi * k / n), y + radius * math.sin(2 * math.pi * k / n)) for k in range(n)]]

    polygons = [(1000, [[(-170.0, -80.0), (170.0, -80.0), (170.0, 80.0), (-170.0, 80.0)]])]
    polygons += [(i, circle(10.0 + i % 15 * 0.01, 20.0 + i // 15 * 0.01, 0.004, 60)) for i in range(225)]
    index = build_index(layer(spark, polygons))
    assert index.cells is not None and index.levels >= 2 and index.cells.agg(F.max("entries")).first()[0] <= 256
    sizes = {r["level"]: r["count"] for r in index.cells.groupBy("level").count().collect()}
    uniform = (360 / index.level_deg(index.levels - 1)) * (180 / index.level_deg(index.levels - 1))
    assert sum(sizes.values()) < 100_000 and sum(sizes.values()) < uniform / 50
    rng = random.Random(8)
    coordinates = [(rng.uniform(9.99, 10.16), rng.uniform(19.99, 20.16)) for _ in range(500)] + [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200)]
    coordinates += [(10.0 + 0.01 * i, 20.0 + 0.01 * i) for i in range(15)]
    assert answer(resolve_polygon(points(spark, coordinates), index)) == plain(polygons, coordinates)


def test_covering_pairs_are_not_shuffled_and_repeated_ids_count_together(spark):
    shapes = [(i, [[(0.0, 0.0), (10.0 + i, 0.0), (10.0 + i, 10.0), (0.0, 10.0)]]) for i in range(5)]
    index = build_index(layer(spark, shapes), 5.0)
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 12.0, 3.0), (3, 2.0, 2.0), (3, 2.0, 2.0), (4, 0.0, 1.0), (4, 0.0, 1.0), (5, None, 1.0)], "id LONG, lon DOUBLE, lat DOUBLE")
    got = covering_pairs(pts, index)
    assert sorted(map(tuple, got.collect())) == sorted([(i, p) for i in (1, 4) for p in range(5)] + [(2, 2), (2, 3), (2, 4)])
    once = covering_pairs(pts.where("id < 3"), index)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in once


def test_pairs_of_many_points_are_tested_in_generated_code_on_a_finer_grid(spark):
    """Level and slanted edges, holes, edges on cell borders, and a shape with many corners in one cell."""
    rng = random.Random(12)
    comb = [(4.0 + i * 0.01, 4.0 + 0.02 * (i % 2)) for i in range(60)] + [(4.6, 3.5), (4.0, 3.5)]
    polygons = [(i, [[(float(x - 4), float(y - 2)), (x + 5.0, y - 2.0), (x + 1.0, float(y)), (x + 5.0, y + 2.0), (x - 4.0, y + 2.0)]])
                for i, (x, y) in enumerate([(0, 0), (3, 1), (-6, 4), (8, -5), (2, 7)])]
    polygons += [(7, [[(-8.0, -8.0), (9.0, -8.0), (9.0, 9.0), (-8.0, 9.0)], [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]]),
                 (8, [comb]), (9, [star(rng, 1, 1, 8, 25)])]
    coordinates = [(rng.uniform(-11, 14), rng.uniform(-9, 10)) for _ in range(4000)] + [(rng.uniform(3.9, 4.7), rng.uniform(3.4, 4.1)) for _ in range(300)]
    coordinates += [(round(rng.uniform(-11, 14) * 4) / 4, round(rng.uniform(-9, 10) * 4) / 4) for _ in range(1500)]
    coordinates += [corner for _, rings in polygons for ring in rings for corner in ring]
    index = build_index(layer(spark, polygons), 10.0)
    got = covering_pairs(points(spark, coordinates), index)
    want = sorted((i, p) for i, (x, y) in enumerate(coordinates) for p, rings in polygons if covers(rings, x, y))
    assert sorted(map(tuple, got.collect())) == want
    branches = got._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1:]
    assert any("lambda" not in branch.split("\n")[0] for branch in branches)
    assert sorted(map(tuple, covering_pairs(points(spark, coordinates), replace(index, cell_deg=0.25)).collect())) == want
    assert pip.pair_cell_deg(index.edges, index.cell_deg, len(coordinates)) < index.cell_deg
    assert pip.pair_cell_deg(index.edges, index.cell_deg, 1) == index.cell_deg


def test_copies_of_a_shape_do_not_crowd_a_cell(spark):
    """More equal borders than a cell may hold: no cell size parts them, and the first copy answers for all."""
    shape = [[(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]]
    polygons = [(i, shape) for i in range(5, 65)] + [(70 + i, [[(6.0, float(i)), (30.0, float(i)), (30.0, i + 9.0)]]) for i in range(6)]
    index = build_index(layer(spark, polygons), split_entries=40)
    assert index.cells.agg(F.max("entries")).first()[0] <= 40 and index.cells.count() < 2_000
    coordinates = [(0.0, 0.0), (8.0, 4.0), (4.0, 4.0), (7.0, 0.1), (20.0, 3.0), (8.0, 8.0), (29.0, 13.0), (-1.0, 0.0)]
    assert answer(resolve_polygon(points(spark, coordinates), index)) == plain(polygons, coordinates)


def test_cells_that_stay_crowded_are_answered_by_pairs(spark):
    """Many polygons through one point: no cell size parts them."""
    fan = [(i, [[(0.0, 0.0), (1.0 + i, 2.0), (2.0 + i, 1.0)]]) for i in range(40)]
    index = build_index(layer(spark, fan), split_entries=20)
    coordinates = [(0.0, 0.0), (1e-6, 1e-6), (0.5, 0.5), (1.5, 1.2), (30.0, 1.0), (-1.0, -1.0)]
    assert answer(resolve_polygon(points(spark, coordinates), index)) == plain(fan, coordinates)
    assert index.cells.agg(F.max("entries")).first()[0] <= 20
