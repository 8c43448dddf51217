"""One runnable query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tremorlake.functions import styling, text, times
from tremorlake.operators import enrich, features, filters, load_windows, pip, playback, proximity, ranking, stats, summaries, tables, textsearch
from tremorlake.operators.filters import EventFilter
from tremorlake.operators.ordering import row_ids
from tremorlake.plans import fixtures as fx, prepared
from tremorlake.schema import FEATURE_OUT
from tremorlake.session import scratch_path, stage
from tremorlake.sources import feed, geojson, polygons, store
from tremorlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters a user of these queries would choose. The tables hold events of January 2024.
RANGE_START, RANGE_END = datetime(2024, 1, 1), datetime(2024, 1, 31)
WANTED = EventFilter.from_text(
    networks_csv="us, ak ,PR", start=datetime(2024, 1, 3), end=datetime(2024, 1, 28, 12), mag_min=0.5, mag_max=9.0,
    depth_min=0.0, depth_max=600.0, text="nation_1", bbox=(170.0, 80.0, -170.0, -80.0))
FETCH_CAP = 500
PLACE_KM = 500.0


def _now() -> Column:
    return F.expr("TIMESTAMP_NTZ'2024-01-31 00:00:00'")


def _mid() -> Column:
    return F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'")


def _ms(moment: datetime) -> int:
    return int(moment.replace(tzinfo=timezone.utc).timestamp() * 1000)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _ntz(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


# --- scans and sources -------------------------------------------------------------------------

@query
def scan_quake(spark, sf_dir):
    return fx.quakes(spark, sf_dir)


@query
def scan_points(spark, sf_dir):
    return enrich.scan_points(fx.quakes(spark, sf_dir))


def _flat(events: DataFrame) -> DataFrame:
    return events.select("usgs_id", "mag", "place", _ntz("time_utc").alias("time_utc"), "url", "tsunami", "title", "net",
                         "depth_km", "lon", "lat")


@query
def read_geojson(spark, sf_dir):
    """All events as FeatureCollection documents of at most 1,000 features, read back."""
    path = scratch_path(spark, "documents")
    numbered = row_ids(fx.quakes(spark, sf_dir), ["time_utc", "id"], 0, "_row")
    docs = numbered.groupBy(F.floor(F.col("_row") / 1000).alias("doc")).agg(
        F.collect_list(features.feed_feature_struct()).alias("features"))
    # one document per file, as a service would have answered
    docs.select("doc", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.partitionBy("doc").text(path)
    return _flat(features.flatten_feature(geojson.read_geojson_features(spark, path)))


@query
def fetch_windows(spark, sf_dir):
    seconds = fx.quakes(spark, sf_dir).select(F.unix_seconds(F.col("time_utc").cast("timestamp")).alias("s"))
    return load_windows.plan_fetch_windows(seconds, _ms(RANGE_START) // 1000, _ms(RANGE_END) // 1000, FETCH_CAP)


@query
def fetch_source(spark, sf_dir):
    """The features of every planned window, flattened. The asking of a service is tested apart.

    Windows are cut at days, so an event finds its window by day and then by the range.
    """
    day = 86_400
    windows = fetch_windows(spark, sf_dir).select("start_s", "end_s", F.explode(F.sequence(
        F.floor(F.col("start_s") / day), F.floor((F.col("end_s") - 1) / day))).alias("day"))
    events = fx.quakes(spark, sf_dir)
    texts = events.select(F.unix_seconds(F.col("time_utc").cast("timestamp")).alias("s"), F.to_json(features.feed_feature_struct()).alias("feature"))
    held = (F.col("s") >= F.col("start_s")) & (F.col("s") < F.col("end_s"))
    answers = texts.withColumn("day", F.floor(F.col("s") / day)).join(windows, "day").where(held).withColumn("status", F.lit("feature"))
    return _flat(features.flatten_feature(feed.fetched_features(answers)))


@query
def month_windows(spark, sf_dir):
    """The last twelve months before the newest event, with the events each window already holds."""
    events = fx.quakes(spark, sf_dir)
    windows = load_windows.month_windows(events.agg(F.date_trunc("month", F.max("time_utc") + F.expr("INTERVAL '31' DAY")).alias("end_ts")))
    # months are few and known, so every event finds its month by key, and its window by the range
    held = windows.withColumn("month", F.date_trunc("month", "window_start")).join(
        events.select("time_utc", F.date_trunc("month", "time_utc").alias("month")), "month", "left")
    inside = (F.col("time_utc") >= F.col("window_start")) & (F.col("time_utc") < F.col("window_end"))
    return held.groupBy("window_start", "window_end").agg(F.count_if(inside).alias("n_events"))


@query
def recent_window(spark, sf_dir):
    events = fx.quakes(spark, sf_dir)
    start, end = load_windows.last_days_window(F.max("time_utc"), 30)
    return events.agg(start.alias("window_start"), end.alias("window_end"))


@query
def country_edges(spark, sf_dir):
    both = polygons.union_layers([fx.country_polygons(spark, sf_dir),
                                  fx.zone_polygons(spark, sf_dir).withColumn("row_id", F.col("row_id") + 100)])
    return polygons.polygon_edges(polygons.country_layer(both))


@query
def sea_edges(spark, sf_dir):
    both = polygons.union_layers([fx.sea_polygons(spark, sf_dir),
                                  fx.basin_polygons(spark, sf_dir).withColumn("row_id", F.col("row_id") + 100)])
    return polygons.polygon_edges(polygons.sea_layer(both))


# --- projections -------------------------------------------------------------------------------

@query
def flatten_feature(spark, sf_dir):
    texts = fx.quakes(spark, sf_dir).select(F.to_json(features.feed_feature_struct()).alias("value"))
    return _flat(features.flatten_feature(geojson.parse_features(texts, "value")))


def _with_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in milliseconds, 0 where the depth is negative and null where it is unknown."""
    ms = times.ts_to_epoch_ms(F.col("time_utc"))
    held = F.when(F.col("depth_km") < 0, F.lit(0).cast("long")).when(F.col("depth_km").isNotNull(), ms)
    return fx.quakes(spark, sf_dir).withColumn("ms", held)


@query
def epoch_ms_to_ts(spark, sf_dir):
    return _with_ms(spark, sf_dir).select("id", _ntz(times.epoch_ms_to_ts(F.col("ms"))).alias("ts"))


@query
def to_feature(spark, sf_dir):
    """Written as JSON text and parsed back."""
    back = features.to_feature(fx.quakes(spark, sf_dir)).select("id", F.from_json("feature", FEATURE_OUT).alias("f"))
    return back.select("id", F.col("f.type").alias("feature_type"), F.size("f.geometry.coordinates").alias("n_coordinates"),
                       "f.properties.*")


@query
def ts_to_epoch_ms(spark, sf_dir):
    return fx.quakes(spark, sf_dir).select("id", times.ts_to_epoch_ms(F.col("time_utc")).alias("ms"))


@query
def event_rows(spark, sf_dir):
    answer = fx.quakes(spark, sf_dir).select("id", features.to_feature_struct().alias("f")).select("id", "f.*")
    return features.event_rows(answer).withColumn("time", _ntz("time"))


@query
def numeric_coerce(spark, sf_dir):
    raw = F.when(F.col("tsunami") == 1, F.col("title")).otherwise(F.split_part("place", F.lit(" "), F.lit(1)))
    return fx.quakes(spark, sf_dir).select("id", text.numeric_coerce(raw).alias("number"))


@query
def to_iso(spark, sf_dir):
    return _with_ms(spark, sf_dir).select("id", times.to_iso(F.col("ms")).alias("iso"))


@query
def display_place(spark, sf_dir):
    return fx.quakes(spark, sf_dir).select("id", text.display_place(F.col("place"), F.col("title")).alias("place_text"))


@query
def normalize_time(spark, sf_dir):
    ms = times.ts_to_epoch_ms(F.col("time_utc"))
    written = F.when(F.col("net") == "AK", F.date_format("time_utc", "yyyy-MM-dd HH:mm:ss")).when(
        F.col("net") == "pr", F.lit("no date"))
    return fx.quakes(spark, sf_dir).select("id", times.normalize_time(
        F.when(F.col("tsunami") == 1, ms), F.when(F.col("net") == "us", ms), written).alias("time_ms"))


@query
def format_event_row(spark, sf_dir):
    return features.format_event_row(fx.quakes(spark, sf_dir))


@query
def clean_lookup_key(spark, sf_dir):
    return fx.zone_polygons(spark, sf_dir).select(
        "row_id", text.clean_lookup_key(F.col("ISO_SOV1")).alias("iso"),
        text.clean_lookup_name(F.col("SOVEREIGN1")).alias("name")).dropna(subset=["iso", "name"])


@query
def mag_radius(spark, sf_dir):
    return fx.quakes(spark, sf_dir).select("id", F.round(styling.mag_radius(F.col("mag")), 6).alias("radius"))


@query
def mag_weight(spark, sf_dir):
    return fx.quakes(spark, sf_dir).select("id", F.round(styling.mag_weight(F.col("mag")), 6).alias("weight"))


@query
def mag_color(spark, sf_dir):
    return fx.quakes(spark, sf_dir).select("id", styling.mag_color(F.col("mag")).alias("color"))


@query
def age_fade(spark, sf_dir):
    age = stats.age_hours(_now(), F.col("time_utc"))
    return fx.quakes(spark, sf_dir).select(
        "id", F.round(styling.age_fade(age), 6).alias("fade"), F.round(styling.circle_opacity(age), 6).alias("opacity"))


@query
def snap_to_hour(spark, sf_dir):
    ms = times.ts_to_epoch_ms(F.col("time_utc"))
    return fx.quakes(spark, sf_dir).select(
        "id", times.snap_to_hour(ms, _ms(datetime(2024, 1, 2)), _ms(datetime(2024, 1, 29))).alias("snapped_ms"))


# --- filters -----------------------------------------------------------------------------------

def _filtered(predicate: Callable[[], Column]) -> Query:
    return lambda spark, sf_dir: fx.quakes(spark, sf_dir).where(predicate())


QUERIES["filter_time"] = _filtered(lambda: filters.time_between(datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18)))
QUERIES["filter_mag"] = _filtered(lambda: filters.mag_between(2.5, 6.0))
QUERIES["filter_depth"] = _filtered(lambda: filters.depth_between(0, 300))
QUERIES["filter_tsunami"] = _filtered(lambda: filters.tsunami_only())
QUERIES["filter_text"] = _filtered(lambda: filters.text_contains("  Click QUAKE "))
QUERIES["filter_network"] = _filtered(lambda: filters.network_in(["US", " ak", ""]))
QUERIES["filter_bbox"] = _filtered(lambda: filters.bbox_intersects(60.0, 45.0, -60.0, -30.0))


SEARCHES = ["us", " Click QUAKE ", "km ne of nation_1", "ew quake, nation_24"]


@query
def search_text(spark, sf_dir):
    """Texts of several lengths, looked for through trigram bitmaps."""
    events = fx.quakes(spark, sf_dir)
    index = stage(textsearch.text_index(events))
    found = [textsearch.search_text(events, index, text).select(F.lit(text.strip().lower()).alias("query"), "id", "place", "title") for text in SEARCHES]
    return reduce(DataFrame.unionByName, found)


@query
def visible_at(spark, sf_dir):
    now, start, end = datetime(2024, 1, 10, 12), datetime(2024, 1, 3), RANGE_END
    return filters.within_ms(fx.quakes(spark, sf_dir), _ms(start), min(_ms(now), _ms(end))).select("id", "time_utc")


@query
def query_events(spark, sf_dir):
    return ranking.query_events(fx.quakes(spark, sf_dir), WANTED)


# --- point in polygon --------------------------------------------------------------------------

def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.scan_points(fx.quakes(spark, sf_dir))


@query
def resolve_country(spark, sf_dir):
    return enrich.resolve_country(_points(spark, sf_dir), prepared.polygon_index(spark, sf_dir, "country"),
                                  fx.country_polygons(spark, sf_dir)).select("id", "country_iso")


@query
def resolve_sea(spark, sf_dir):
    return enrich.resolve_sea(_points(spark, sf_dir), prepared.polygon_index(spark, sf_dir, "sea"),
                              fx.sea_polygons(spark, sf_dir), prepared.seas(spark, sf_dir)).select("id", "sea_id")


@query
def resolve_zone(spark, sf_dir):
    """As for countries, on a layer whose number of polygons grows with the data."""
    return pip.resolve_polygon(_points(spark, sf_dir), prepared.polygon_index(spark, sf_dir, "zone")).select("id", "poly")


@query
def resolve_basin(spark, sf_dir):
    """As for seas, on thousands of small polygons with holes."""
    return pip.resolve_polygon(_points(spark, sf_dir), prepared.polygon_index(spark, sf_dir, "basin")).select("id", "poly")


def _located(spark: SparkSession, sf_dir: str, points: DataFrame) -> DataFrame:
    return enrich.resolve_location(
        points, prepared.polygon_index(spark, sf_dir, "country"), fx.country_polygons(spark, sf_dir),
        prepared.polygon_index(spark, sf_dir, "sea"), fx.sea_polygons(spark, sf_dir), prepared.seas(spark, sf_dir))


@query
def resolve_location(spark, sf_dir):
    return enrich.location_rows(_located(spark, sf_dir, _points(spark, sf_dir)))


@query
def pip_candidates(spark, sf_dir):
    return pip.pip_candidates(_points(spark, sf_dir), prepared.polygon_index(spark, sf_dir, "country"))


@query
def covering_pairs(spark, sf_dir):
    """The shuffle form for layers that outgrow cell rows; the same test, all covering polygons."""
    return pip.covering_pairs(_points(spark, sf_dir), prepared.polygon_index(spark, sf_dir, "zone"))


# --- aggregations ------------------------------------------------------------------------------

@query
def count_quakes(spark, sf_dir):
    return stats.count_quakes(fx.quakes(spark, sf_dir))


@query
def histogram_mag(spark, sf_dir):
    return stats.histogram(fx.quakes(spark, sf_dir), "mag", 30)


def _known_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.quakes(spark, sf_dir).where(filters.depth_known_nonnegative())


@query
def histogram_depth(spark, sf_dir):
    return stats.histogram(_known_depth(spark, sf_dir), "depth_km", 40)


@query
def histogram_log(spark, sf_dir):
    return stats.histogram(fx.quakes(spark, sf_dir), "mag", 30, log_scale=True)


@query
def describe_mag(spark, sf_dir):
    return stats.describe(fx.quakes(spark, sf_dir), "mag")


@query
def describe_depth(spark, sf_dir):
    return stats.describe(_known_depth(spark, sf_dir), "depth_km")


@query
def describe_depth_ranked(spark, sf_dir):
    """The form for very many distinct values: quartiles by rank over range partitions."""
    return stats.describe(_known_depth(spark, sf_dir), "depth_km", max_counted=0)


@query
def describe_sketched(spark, sf_dir):
    """Depths of three weeks from stored daily summaries; the quartiles are held against the ranks they have in the rows."""
    start, end = datetime(2024, 1, 3, 6), datetime(2024, 1, 24, 18, 30)
    events = _known_depth(spark, sf_dir)
    stored = stage(summaries.summarize(events, "time_utc", "depth_km", "day"))
    found = summaries.describe_range(stored, events, "time_utc", "depth_km", start, end, "day").first()
    inside = events.where(F.col("time_utc").between(F.lit(start), F.lit(end)) & (F.col("time_utc") < F.lit(end)))

    def close(name: str) -> Column:
        below = F.count_if(F.col("depth_km") < F.lit(found[name])) / F.count(F.lit(1))
        upto = F.count_if(F.col("depth_km") <= F.lit(found[name])) / F.count(F.lit(1))
        wanted = F.lit(summaries.QUARTILES[name])
        return ((below - summaries.RANK_ERROR <= wanted) & (wanted <= upto + summaries.RANK_ERROR)).alias(f"{name}_close")

    return inside.agg(
        F.lit(found["count"]).alias("count"), *[F.round(F.lit(found[n]), 6).alias(n) for n in ("mean", "std")],
        F.lit(found["min"]).alias("min"), F.lit(found["max"]).alias("max"), *[close(n) for n in summaries.QUARTILES])


@query
def country_lookup(spark, sf_dir):
    return tables.country_lookup(fx.zone_polygons(spark, sf_dir))


@query
def sea_lookup(spark, sf_dir):
    return tables.sea_lookup(fx.basin_polygons(spark, sf_dir))


@query
def heat_density(spark, sf_dir):
    return stats.heat_density(fx.quakes(spark, sf_dir), _now(), 10.0)


# --- ids, repeats, order -----------------------------------------------------------------------

@query
def dense_id(spark, sf_dir):
    new = fx.quakes(spark, sf_dir).select("time_utc", "usgs_id", "id")
    return tables.dense_ids(new, 1000, out="dense_id")


@query
def dedup_first(spark, sf_dir):
    return tables.first_write_wins(fx.quakes(spark, sf_dir), "usgs_id", ["id"])


@query
def newest_k(spark, sf_dir):
    return ranking.newest_k(fx.quakes(spark, sf_dir))


@query
def table_sorted(spark, sf_dir):
    return ranking.table_sorted(event_rows(spark, sf_dir))


@query
def map_table(spark, sf_dir):
    events = fx.quakes(spark, sf_dir)
    ordered = ranking.map_table_sorted(events, times.ts_to_epoch_ms(F.col("time_utc")))
    return ordered.select("id", "time_utc", text.display_place(F.col("place"), F.col("title")).alias("place_text"), "mag")


@query
def union_windows(spark, sf_dir):
    events = fx.quakes(spark, sf_dir)
    return feed.union_fetches([events.where(F.col("time_utc") < _mid()), events.where(F.col("time_utc") >= _mid())])


# --- inserts, upserts, integrity ---------------------------------------------------------------

@query
def insert_new(spark, sf_dir):
    """Store the first two weeks, then offer everything: the store after the insert."""
    events = fx.quakes(spark, sf_dir)
    stored = tables.first_write_wins(events.where(F.col("time_utc") < _mid()), "usgs_id", ["id"])
    return stored.unionByName(tables.insert_new(stored, events))


@query
def insert_filtered(spark, sf_dir):
    """The same in the event store, which opens only folders whose key filter may hold an offered id."""
    path = scratch_path(spark, "filtered")
    events = fx.quakes(spark, sf_dir)
    for name, offered in (("first", events.where(F.col("time_utc") < _mid())), ("second", events)):
        store.load_batch(spark, path, offered, ["id"], name)
    return store.scan_quake(spark, path).select("usgs_id", "mag", _ntz("time_utc").alias("time_utc"), "title", "net", "depth_km", "lon", "lat")


@query
def upsert_country(spark, sf_dir):
    return tables.upsert_country(tables.country_lookup(fx.country_polygons(spark, sf_dir)),
                                 tables.country_lookup(fx.zone_polygons(spark, sf_dir)))


@query
def upsert_sea(spark, sf_dir):
    """A stored sea whose id the new layer lacks stays."""
    stored = prepared.seas(spark, sf_dir).unionByName(spark.sql("SELECT 100000 AS id, 'Old Sea' AS name"))
    return tables.upsert_sea(stored, tables.sea_lookup(fx.basin_polygons(spark, sf_dir)))


def _zone_location(spark: SparkSession, sf_dir: str, points: DataFrame) -> DataFrame:
    found = enrich.resolve_country(points, prepared.polygon_index(spark, sf_dir, "zone"), fx.zone_polygons(spark, sf_dir))
    return found.select(F.col("id").alias("quake_id"), "country_iso", F.lit(None).cast("int").alias("sea_id"))


@query
def upsert_location(spark, sf_dir):
    """All events resolved, then the later half resolved again on another layer, nulls included."""
    later = enrich.scan_points(fx.quakes(spark, sf_dir).where(F.col("time_utc") >= _mid()))
    return tables.upsert_location(resolve_location(spark, sf_dir), _zone_location(spark, sf_dir, later))


@query
def resolve_incremental(spark, sf_dir):
    """Only the events that have no location yet."""
    earlier = fx.quakes(spark, sf_dir).where(F.col("time_utc") < _mid())
    stored = enrich.scan_points(earlier).select(F.col("id").alias("quake_id"))
    fresh = tables.unresolved_points(_points(spark, sf_dir), stored)
    return enrich.location_rows(_located(spark, sf_dir, fresh))


@query
def relocate_changed(spark, sf_dir):
    """Locations after countries left the layer: only events in changed cells are resolved again."""
    points, index = _points(spark, sf_dir), lambda name: prepared.polygon_index(spark, sf_dir, name)
    seas = index("sea"), fx.sea_polygons(spark, sf_dir), prepared.seas(spark, sf_dir)
    old = index("country"), fx.country_polygons(spark, sf_dir)
    new = index("fewer_countries"), prepared.fewer_countries(spark, sf_dir)
    touched = enrich.points_to_relocate(points, old, new, seas, seas)
    before = enrich.location_rows(enrich.resolve_location(points, *old, *seas))
    return tables.upsert_location(before, enrich.location_rows(enrich.resolve_location(touched, *new, *seas)))


@query
def load_log(spark, sf_dir):
    """Submitted and really inserted rows per network and day, appended and read back."""
    events = fx.quakes(spark, sf_dir)
    path = scratch_path(spark, "log")
    load_windows.load_log_rows(events, tables.first_write_wins(events, "usgs_id", ["id"]), "net").write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query
def feature_collection(spark, sf_dir):
    """One document of the newest 5,000 events, parsed back into rows."""
    doc = features.feature_collection(fx.quakes(spark, sf_dir), filters.DEFAULT_LIMIT)
    parsed = doc.select(F.from_json("document", f"type STRING, features ARRAY<{FEATURE_OUT.simpleString()}>").alias("d"))
    rows = parsed.select(F.col("d.type").alias("document_type"), F.posexplode("d.features").alias("position", "f"))
    return rows.select("document_type", "position", "f.properties.*")


@query
def check_unique(spark, sf_dir):
    return tables.check_unique(fx.quakes(spark, sf_dir), "usgs_id")


@query
def check_not_null(spark, sf_dir):
    return tables.check_not_null(fx.quakes(spark, sf_dir), ["id", "usgs_id", "mag", "lon"])


@query
def check_references(spark, sf_dir):
    return tables.check_references(_zone_location(spark, sf_dir, _points(spark, sf_dir)), "country_iso",
                                   tables.country_lookup(fx.country_polygons(spark, sf_dir)), "iso")


@query
def delete_cascade(spark, sf_dir):
    gone = fx.quakes(spark, sf_dir).where("tsunami = 1")
    return tables.delete_cascade(resolve_location(spark, sf_dir), gone)


@query
def delete_set_null(spark, sf_dir):
    gone = tables.country_lookup(fx.country_polygons(spark, sf_dir)).where("iso < 'N10'")
    return tables.delete_set_null(resolve_location(spark, sf_dir), "country_iso", gone, "iso")


# --- playback ----------------------------------------------------------------------------------

@query
def playback_counts(spark, sf_dir):
    return playback.playback_counts(fx.quakes(spark, sf_dir), _ms(datetime(2024, 1, 2)), _ms(datetime(2024, 1, 30, 6)), 1)


@query
def playback_heat(spark, sf_dir):
    return playback.playback_heat(fx.quakes(spark, sf_dir), _ms(datetime(2024, 1, 2)), _ms(datetime(2024, 1, 30, 6)), 4, 20.0)


# --- proximity, reports ------------------------------------------------------------------------

@query
def last_within_km(spark, sf_dir):
    return proximity.last_within_km(fx.quakes(spark, sf_dir), fx.watched_places(spark, sf_dir), PLACE_KM)


@query
def frequency_grid(spark, sf_dir):
    """The last 24 hours."""
    return stats.frequency_grid(fx.quakes(spark, sf_dir), _now(), 24, 10.0)


@query
def frequency_grid_year(spark, sf_dir):
    """The last 365 days."""
    return stats.frequency_grid(fx.quakes(spark, sf_dir), _now(), 365 * 24, 5.0)


@query
def tsunami_near(spark, sf_dir):
    return proximity.tsunami_near(fx.quakes(spark, sf_dir), fx.watched_places(spark, sf_dir), PLACE_KM, _mid())


@query
def quakes_by_country(spark, sf_dir):
    located = enrich.resolve_country(
        fx.quakes(spark, sf_dir).where("lon IS NOT NULL AND lat IS NOT NULL"),
        prepared.polygon_index(spark, sf_dir, "country"), fx.country_polygons(spark, sf_dir))
    countries = tables.country_lookup(fx.country_polygons(spark, sf_dir))
    return proximity.quakes_by_country(located, countries, "N07", 2.0, _now() - F.expr("INTERVAL '20' DAY"))


@query
def strongest_k(spark, sf_dir):
    return ranking.strongest_k(fx.quakes(spark, sf_dir), 100)


@query
def nearest_k(spark, sf_dir):
    return ranking.nearest_k(fx.quakes(spark, sf_dir), 16.37, 48.21, 100)


@query
def nearest_k_per_place(spark, sf_dir):
    return proximity.nearest_k_per_place(fx.quakes(spark, sf_dir), fx.watched_places(spark, sf_dir), 5)


@query
def hourly_counts(spark, sf_dir):
    return stats.counts_per_hour(fx.quakes(spark, sf_dir))


@query
def coverage_gaps(spark, sf_dir):
    return load_windows.coverage_gaps(fx.load_log(spark, sf_dir))


@query
def backfill_windows(spark, sf_dir):
    """What each source still lacks of January, in windows of at most six hours."""
    log = fx.load_log(spark, sf_dir)
    wanted = log.select("source").distinct().select(
        "source", F.lit(RANGE_START).cast("timestamp_ntz").alias("wanted_start"), F.lit(RANGE_END).cast("timestamp_ntz").alias("wanted_end"))
    return load_windows.backfill_windows(log, wanted, 6 * 3600)


@query
def latest_coverage(spark, sf_dir):
    return load_windows.latest_coverage(fx.load_log(spark, sf_dir))


@query
def country_stats(spark, sf_dir):
    """Every event with its country and sea, evaluated per country and sea."""
    located = fx.quakes(spark, sf_dir).where("lon IS NOT NULL AND lat IS NOT NULL")
    return enrich.country_stats(_located(spark, sf_dir, located.select("id", "lon", "lat", "mag", "depth_km")))


# --- streams over landed snapshots -------------------------------------------------------------

def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.stream_features(spark, prepared.landed_feed(spark, sf_dir))


def _appended(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    with jobs.state_partitions(spark):
        run = jobs.start_append(stream, path, path + "-progress")
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _updated(spark: SparkSession, stream: DataFrame, label: str, keys: list[str]) -> DataFrame:
    path = scratch_path(spark, label)
    with jobs.state_partitions(spark):
        run = jobs.start_updates(stream, path, path + "-progress", keys)
    run.awaitTermination()
    return jobs.latest_updates(spark.read.parquet(path), keys)


@query
def stream_features(spark, sf_dir):
    return _flat(_appended(spark, _stream(spark, sf_dir), "features"))


@query
def stream_dedup(spark, sf_dir):
    return _appended(spark, jobs.stream_dedup(_stream(spark, sf_dir)), "dedup").select("usgs_id")


@query
def stream_tumbling(spark, sf_dir):
    counts = _updated(spark, jobs.stream_counts(_stream(spark, sf_dir)), "tumbling", ["window_start", "window_end"])
    return counts.select(_ntz("window_start").alias("window_start"), _ntz("window_end").alias("window_end"), "n_events")


@query
def stream_sliding(spark, sf_dir):
    sliding = jobs.stream_counts(_stream(spark, sf_dir), "24 hours", "1 hour")
    counts = _updated(spark, sliding, "sliding", ["window_start", "window_end"])
    return counts.select(_ntz("window_start").alias("window_start"), _ntz("window_end").alias("window_end"), "n_events")


@query
def stream_insert_new(spark, sf_dir):
    path = scratch_path(spark, "store")
    jobs.start_insert_new(_stream(spark, sf_dir), path, path + "-progress", ["time_utc"]).awaitTermination()
    return spark.read.parquet(path).select("usgs_id", _ntz("time_utc").alias("time_utc"), "mag", "lon", "lat")


@query
def tsunami_alerts(spark, sf_dir):
    alerts = jobs.tsunami_alerts(_stream(spark, sf_dir), fx.watched_places(spark, sf_dir), PLACE_KM)
    return _appended(spark, alerts, "alerts").select("usgs_id", "place")


@query
def stream_last_quake(spark, sf_dir):
    path = scratch_path(spark, "last")
    jobs.start_last_quake(_stream(spark, sf_dir), fx.watched_places(spark, sf_dir), PLACE_KM, path, path + "-progress").awaitTermination()
    return jobs.latest_quake(spark.read.parquet(path)).withColumn("time_utc", _ntz("time_utc"))
