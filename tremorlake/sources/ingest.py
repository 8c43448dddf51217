"""Whole loads: windows to store and log, and locations of what is new."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tremorlake.operators.enrich import location_rows, points_to_relocate, resolve_location, scan_points
from tremorlake.operators.features import flatten_feature
from tremorlake.operators.load_windows import month_windows
from tremorlake.operators.pip import PolygonIndex
from tremorlake.operators.stats import needs_initial_load
from tremorlake.operators.tables import first_write_wins, unresolved_points
from tremorlake.schema import FEATURE_IN
from tremorlake.session import owned_stages, stage
from tremorlake.sources import store
from tremorlake.sources.feed import Fetch, fetch_log, fetch_windows
from tremorlake.sources.geojson import readable_feature

INITIAL_DAYS = 30


def load_windows(spark: SparkSession, store_path: str, log_path: str, windows: DataFrame, fetch: Fetch, source: str,
                 load_id: str, created_at: datetime) -> tuple[int, int]:
    """Fetch ``(window_start, window_end)`` rows, store what is new and log every window.

    Answers are landed before they are used, so the service is asked once. The log holds, per window asked for in
    the end, what came, what was inserted and how the fetch ended; only successful windows count as covered.
    Repeating a ``load_id`` replaces its events and its log.
    """
    with owned_stages(spark):
        landed = stage(fetch_windows(windows, fetch))
        features = landed.where("status = 'feature'").where(readable_feature("feature")).select(
            "window_start", "window_end", F.from_json("feature", FEATURE_IN).alias("f")).select("window_start", "window_end", "f.*")
        counts = store.load_batch(spark, store_path, flatten_feature(features, keep=["window_start"]), ["window_start", "updated_utc"], load_id)

        stored = store.scan_quake(spark, store_path).where(F.col(store.LOAD) == load_id).select("usgs_id")
        first_seen = first_write_wins(features.select("window_start", F.col("id").alias("usgs_id")), "usgs_id", ["window_start"])
        keyed = first_seen.join(stored, "usgs_id", "left_semi").select("window_start")
        keyless = first_seen.where("usgs_id IS NULL").select("window_start")
        kept = keyed.unionAll(keyless).groupBy(F.col("window_start").alias("start_time_utc")).agg(F.count(F.lit(1)).alias("rows_inserted"))
        log = fetch_log(landed, source).join(kept, "start_time_utc", "left").select(
            "source", F.col("start_time_utc").cast("timestamp").alias("start_time_utc"),
            F.col("end_time_utc").cast("timestamp").alias("end_time_utc"), "rows_submitted",
            F.coalesce("rows_inserted", F.lit(0)).cast("long").alias("rows_inserted"), "status",
            F.lit(created_at).cast("timestamp").alias("created_at"))
        store.write_load_log(log, log_path, load_id)
        return counts


def load_year(spark: SparkSession, store_path: str, log_path: str, fetch: Fetch, source: str, now: datetime) -> tuple[int, int]:
    """The twelve months before the month of ``now``, month by month; a month that the service refuses is split."""
    ends = spark.range(1).select(F.lit(now).cast("timestamp_ntz").alias("end_ts"))
    return load_windows(spark, store_path, log_path, month_windows(ends), fetch, source, f"year-{now:%Y%m}", now)


def load_recent(spark: SparkSession, store_path: str, log_path: str, fetch: Fetch, source: str, now: datetime,
                days: int = INITIAL_DAYS, window: timedelta = timedelta(days=1)) -> tuple[int, int]:
    """First load of an empty store: the last ``days`` days in equal windows; does nothing otherwise."""
    if not needs_initial_load(store.scan_quake(spark, store_path)):
        return 0, 0
    end = now.replace(microsecond=0)
    start = end - timedelta(days=days)
    count = -(-(end - start) // window)
    at = F.lit(start).cast("timestamp_ntz")
    seconds = int(window.total_seconds())
    windows = spark.range(count).select(
        F.timestamp_add("SECOND", F.col("id").cast("int") * seconds, at).alias("window_start"),
        F.least(F.timestamp_add("SECOND", (F.col("id").cast("int") + 1) * seconds, at), F.lit(end).cast("timestamp_ntz")).alias("window_end"))
    return load_windows(spark, store_path, log_path, windows, fetch, source, f"initial-{end:%Y%m%dT%H%M%S}", now)


def locate_new(spark: SparkSession, store_path: str, location_path: str, country_index: PolygonIndex, countries: DataFrame,
               sea_index: PolygonIndex, sea_polygons: DataFrame, seas: DataFrame) -> None:
    """Resolve the stored events that have no location row yet and upsert their rows."""
    fresh = unresolved_points(scan_points(store.scan_quake(spark, store_path)), store.read_location(spark, location_path))
    resolved = resolve_location(fresh, country_index, countries, sea_index, sea_polygons, seas)
    store.write_location(spark, location_path, location_rows(resolved))


def relocate_changed(spark: SparkSession, store_path: str, location_path: str, old_country: tuple[PolygonIndex, DataFrame],
                     new_country: tuple[PolygonIndex, DataFrame], old_sea: tuple[PolygonIndex, DataFrame, DataFrame],
                     new_sea: tuple[PolygonIndex, DataFrame, DataFrame]) -> int:
    """Resolve again the stored events that a change of the layers may touch; returns how many rows it wrote.

    Rows that became null are rewritten too. Id blocks without such an event keep their files.
    """
    with owned_stages(spark):
        points = scan_points(store.scan_quake(spark, store_path))
        touched = stage(points_to_relocate(points, old_country, new_country, old_sea, new_sea))
        rows = stage(location_rows(resolve_location(touched, *new_country, *new_sea)))
        old = store.read_location(spark, location_path).withColumnsRenamed({"country_iso": "_iso", "sea_id": "_sea"})
        # ids of the touched events only; an answer that stayed the same is not written again
        changed = stage(rows.join(old, "quake_id", "left").where(
            ~F.col("_iso").eqNullSafe(F.col("country_iso")) | ~F.col("_sea").eqNullSafe(F.col("sea_id"))).select(*rows.columns))
        written = changed.count()
        if written:
            store.write_location(spark, location_path, changed)
        return written
