"""Scalar rules: null, zero, boundary and rounding cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tremorlake.functions import styling, text, times
from tremorlake.operators import features
from tremorlake.sources.geojson import land_feed_snapshot, parse_features, read_feature_lines, read_geojson_features, write_feature_lines


def values(spark, kind, data, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_epoch_zero_and_null_are_missing(spark):
    got = values(spark, "LONG", [0, None, 1_700_000_000_123], lambda v: times.epoch_ms_to_ts(v).cast("timestamp_ntz"))
    assert got == [None, None, datetime(2023, 11, 14, 22, 13, 20, 123000)]
    assert values(spark, "LONG", [0, None, 1_700_000_000_123], times.to_iso) == ["—", "—", "2023-11-14 22:13:20"]


def test_snap_to_hour_rounds_half_up_and_clamps(spark):
    hour = times.HOUR_MS
    got = values(spark, "LONG", [0, hour * 5 + hour // 2, hour * 5 + hour // 2 - 1, hour * 50],
                 lambda v: times.snap_to_hour(v, hour * 2, hour * 9))
    assert got == [hour * 2, hour * 6, hour * 5, hour * 9]


def test_normalize_time_order(spark):
    rows = spark.createDataFrame([(5, 6, "2024-01-01 00:00:00"), (None, 6, None), (None, None, "2024-01-01 00:00:00"),
                                  (None, None, "nonsense"), (None, None, None), (None, 0, None)], "a LONG, b LONG, t STRING")
    got = [r[0] for r in rows.select(times.normalize_time(F.col("a"), F.col("b"), F.col("t"))).collect()]
    assert got == [5, 6, 1704067200000, 0, 0, 0]


def test_display_place(spark):
    rows = spark.createDataFrame([("p", "t"), ("", "t"), (None, "t"), (None, ""), (None, None)], "p STRING, t STRING")
    assert [r[0] for r in rows.select(text.display_place(F.col("p"), F.col("t"))).collect()] == ["p", "t", "t", "—", "—"]


def test_lookup_keys(spark):
    data = [" abc ", "na", "N/A", "None", "", None, "nan"]
    assert values(spark, "STRING", data, text.clean_lookup_key) == ["ABC", None, None, None, None, None, "NAN"]
    assert values(spark, "STRING", data, text.clean_lookup_name) == ["abc", "na", None, "None", None, None, "nan"]


def test_numbers(spark):
    assert values(spark, "STRING", ["1.5", "x", None, " 2 "], text.numeric_coerce) == [1.5, None, None, 2.0]


def test_fixed_decimals_round_exact_values_and_halves_outwards(spark):
    got = values(spark, "DOUBLE", [0.25, 0.75, 1.15, -0.25, 2.0, None, 1234.5], lambda v: text.fixed_or_dash(v, 1))
    assert got == ["0.3", "0.8", "1.1", "-0.3", "2.0", "—", "1234.5"]
    assert values(spark, "DOUBLE", [0.0625, 0.1875], lambda v: text.fixed_or_dash(v, 3)) == ["0.063", "0.188"]


def test_networks_from_text():
    assert text.search_terms(" us, AK,,pr ,us", separator=",") == ["us", "ak", "pr"]
    assert text.search_terms("", None, separator=",") == []


@pytest.mark.parametrize("mag, radius, weight, color", [
    (None, 3.0, 0.1, "#4fe08a"), (-2.0, 3.0, 0.1, "#4fe08a"), (0.0, 3.0, 0.1, "#4fe08a"), (1.0, 4.0, 0.2, None),
    (3.0, 6.5, 0.5, "#ffd166"), (5.0, 11.0, 0.85, "#ef476f"), (7.0, 20.0, 1.0, "#d90429"), (9.5, 20.0, 1.0, "#d90429")])
def test_magnitude_styles(spark, mag, radius, weight, color):
    row = spark.createDataFrame([(mag,)], "mag DOUBLE").select(
        styling.mag_radius(F.col("mag")), styling.mag_weight(F.col("mag")), styling.mag_color(F.col("mag"))).first()
    assert row[0] == pytest.approx(radius) and row[1] == pytest.approx(weight)
    assert color is None or row[2] == color


def test_fading_is_clamped(spark):
    got = values(spark, "DOUBLE", [-5.0, 0.0, 3.0, 6.0, 24.0, 72.0, 500.0], styling.age_fade)
    assert got == pytest.approx([1.0, 1.0, 0.7, 0.4, 0.1, 0.0, 0.0])
    assert values(spark, "DOUBLE", [-5.0, 3.0, 80.0], styling.circle_opacity) == pytest.approx([0.9, 0.65, 0.0])


DOCUMENT = """{"type": "FeatureCollection", "features": [
 {"type": "Feature", "id": "a", "geometry": {"type": "Point", "coordinates": [10.5, -3.25, 7.0]},
  "properties": {"mag": 4.5, "place": "here", "time": 1700000000123, "updated": 0, "url": "u", "detail": "d", "tsunami": 1,
   "sig": 300, "magType": "mw", "type": "earthquake", "title": "t", "net": "us", "code": "c"}},
 {"type": "Feature", "id": "b", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}, "properties": {"mag": null, "time": 0}},
 {"type": "Feature", "id": "c", "geometry": null, "properties": {"mag": 1.0}},
 {"type": "Feature", "id": null, "properties": {"mag": 2.0}}]}"""


def test_features_flatten_and_bad_geometry_gives_nulls(spark, tmp_path):
    (tmp_path / "one.json").write_text(DOCUMENT)
    (tmp_path / "two.json").write_text('{"type": "FeatureCollection"}')
    rows = {r["usgs_id"]: r for r in features.flatten_feature(read_geojson_features(spark, str(tmp_path))).collect()}
    assert len(rows) == 4
    a = rows["a"]
    assert (a["lon"], a["lat"], a["depth_km"], a["mag_type"], a["typ"], a["detail_url"], a["sig"]) == (10.5, -3.25, 7.0, "mw", "earthquake", "d", 300)
    assert a["updated_utc"] is None and a["time_utc"] is not None
    assert (rows["b"]["lon"], rows["b"]["lat"], rows["b"]["depth_km"], rows["b"]["time_utc"]) == (1.0, 2.0, None, None)
    assert (rows["c"]["lon"], rows["c"]["mag"]) == (None, 1.0)


EVENT = ("id LONG, usgs_id STRING, mag DOUBLE, place STRING, time_utc TIMESTAMP, url STRING, tsunami INT, title STRING, net STRING, "
         "depth_km DOUBLE, lon DOUBLE, lat DOUBLE")


def events(spark, *rows):
    base = dict(id=1, usgs_id="a", mag=1.0, place="p", time_utc=datetime(2024, 1, 1), url="u", tsunami=0, title="t", net="us",
                depth_km=5.0, lon=1.0, lat=2.0)
    names = list(base)
    return spark.createDataFrame([tuple({**base, **r}[n] for n in names) for r in rows], EVENT)


def test_answer_features(spark):
    df = events(spark, {}, {"id": 2, "lon": None, "time_utc": None, "tsunami": None, "mag": None})
    texts = {r["id"]: r["feature"] for r in features.to_feature(df).collect()}
    assert texts[1] == ('{"type":"Feature","geometry":{"type":"Point","coordinates":[1.0,2.0]},"properties":{"time":1704067200000,'
                        '"mag":1.0,"place":"p","depth_km":5.0,"lon":1.0,"lat":2.0,"tsunami":0,"net":"us","url":"u","title":"t"}}')
    assert texts[2].startswith('{"type":"Feature","geometry":null,"properties":{"time":0,"mag":null,')


def test_feature_lines_round_trip(spark, tmp_path):
    df = events(spark, {}, {"id": 2, "usgs_id": None, "lat": None})
    write_feature_lines(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    land_feed_snapshot(df, str(tmp_path / "feed"))
    back = features.flatten_feature(read_feature_lines(spark, str(tmp_path / "feed"))).collect()
    assert {(r["usgs_id"], r["lon"], r["depth_km"]) for r in back} == {("a", 1.0, 5.0), (None, None, None)}


def test_feature_collection_is_one_document(spark):
    df = events(spark, *[{"id": i, "time_utc": datetime(2024, 1, i + 1)} for i in range(5)])
    doc = features.feature_collection(df, 3).collect()
    assert len(doc) == 1 and doc[0]["document"].count('"type":"Feature"') == 3
    assert doc[0]["document"].index("1704412800000") < doc[0]["document"].index("1704326400000")
    assert features.feature_collection(df.limit(0), 3).first()["document"] == '{"type":"FeatureCollection","features":[]}'


def test_event_rows_drop_bare_features_and_keep_unknown_times(spark):
    texts = spark.createDataFrame([(t,) for t in (
        '{"geometry": {"coordinates": [1, 2, 3]}, "properties": {"time": null, "mag": 1.5, "title": "t"}}',
        '{"geometry": {"coordinates": [1, 2]}, "properties": {"time": 5}}',
        '{"geometry": null, "properties": {"time": 5}}',
        '{"geometry": {"type": "Point"}, "properties": {"time": 5}}')], "v STRING")
    with_depth = parse_features(texts, "v").withColumn("properties", F.col("properties").withField("depth_km", F.lit(9.0)))
    rows = sorted((tuple(r) for r in features.event_rows(with_depth).select("time_ms", "lon", "depth_km", "place").collect()), key=str)
    assert rows == sorted([(None, 1.0, 3.0, "t"), (5.0, 1.0, 9.0, None), (5.0, None, None, None)], key=str)


def test_format_event_row(spark):
    row = features.format_event_row(events(spark, {"mag": None, "url": None, "net": "", "place": "", "tsunami": None, "lon": 12.3456})).first()
    assert tuple(row)[1:] == ("2024-01-01 00:00:00.000 Z", "t", "—", "5.0", "—", 0, "12.346", "2.000", "#")




def test_lookup_keys_lose_all_outer_white_space(spark):
    df = spark.createDataFrame([("\tDE\n",), ("\u00a0 n/a\r",), ("A B",), (None,)], "k STRING")
    assert [r[0] for r in df.select(text.clean_lookup_key(F.col("k"))).collect()] == ["DE", None, "A B", None]


def test_numbers_have_no_type_suffix(spark):
    values = ["1d", "2.5f", "1e3", " 7 ", "-.5", "3.", "x", "", None, "inf", "1e"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v STRING").select(text.numeric_coerce(F.col("v"))).collect()]
    assert got == [None, None, 1000.0, 7.0, -0.5, 3.0, None, None, None, float("inf"), None]
