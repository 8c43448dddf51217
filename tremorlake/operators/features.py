"""GeoJSON features to event rows and back, as projections on nested columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.functions.text import display_place, fixed_or_dash, numeric_coerce
from tremorlake.functions.times import NO_VALUE, epoch_ms_to_ts, ms_to_datetime, ts_to_epoch_ms

_FULL_JSON = {"ignoreNullFields": "false"}


def flatten_feature(features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows ``(id, geometry, properties)`` of the feed to event rows, after the columns to ``keep``.

    Short or missing coordinates give nulls and keep the row.
    """
    p, coordinates = F.col("properties"), F.col("geometry.coordinates")
    return features.select(
        *keep,
        F.col("id").alias("usgs_id"),
        p["mag"].alias("mag"),
        p["place"].alias("place"),
        epoch_ms_to_ts(p["time"]).alias("time_utc"),
        epoch_ms_to_ts(p["updated"]).alias("updated_utc"),
        p["url"].alias("url"),
        p["detail"].alias("detail_url"),
        p["tsunami"].alias("tsunami"),
        p["sig"].alias("sig"),
        p["magType"].alias("mag_type"),
        p["type"].alias("typ"),
        p["title"].alias("title"),
        p["net"].alias("net"),
        p["code"].alias("code"),
        F.get(coordinates, F.lit(2)).alias("depth_km"),
        F.get(coordinates, F.lit(0)).alias("lon"),
        F.get(coordinates, F.lit(1)).alias("lat"),
    )


def feed_feature_struct() -> Column:
    """An event row as a feed feature, the inverse of ``flatten_feature`` for the columns at hand."""
    return F.struct(
        F.lit("Feature").alias("type"),
        F.col("usgs_id").alias("id"),
        F.when(
            F.col("lon").isNotNull() & F.col("lat").isNotNull(),
            F.struct(F.lit("Point").alias("type"), F.array("lon", "lat", "depth_km").alias("coordinates")),
        ).alias("geometry"),
        F.struct(
            "mag", "place", ts_to_epoch_ms(F.col("time_utc")).alias("time"), "url", "tsunami", "title", "net",
        ).alias("properties"),
    )


def to_feature_struct() -> Column:
    """An event row as an answer feature: point of two numbers or null geometry, ten properties."""
    return F.struct(
        F.lit("Feature").alias("type"),
        F.when(
            F.col("lon").isNotNull() & F.col("lat").isNotNull(),
            F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")),
        ).alias("geometry"),
        F.struct(
            F.coalesce(ts_to_epoch_ms(F.col("time_utc")), F.lit(0)).cast("long").alias("time"),
            "mag", "place", "depth_km", "lon", "lat",
            F.coalesce("tsunami", F.lit(0)).cast("int").alias("tsunami"),
            "net", "url", "title",
        ).alias("properties"),
    )


def to_feature(quakes: DataFrame) -> DataFrame:
    """One JSON feature per event, null fields kept."""
    return quakes.select("id", F.to_json(to_feature_struct(), _FULL_JSON).alias("feature"))


def feature_collection(quakes: DataFrame, limit: int) -> DataFrame:
    """One FeatureCollection document, newest first, of at most ``limit`` events.

    The limit bounds the one row that holds the document; write larger answers as lines with
    ``sources.geojson.write_feature_lines``.
    """
    newest = quakes.orderBy(F.col("time_utc").desc_nulls_first(), F.col("id")).limit(limit)
    ranked = newest.select(F.struct(
        (-F.coalesce(F.unix_micros(F.col("time_utc").cast("timestamp")), F.lit(2 ** 62))).alias("k"), F.col("id").alias("i"),
        to_feature_struct().alias("f"),
    ).alias("r"))
    features = F.transform(F.sort_array(F.collect_list("r")), lambda r: r["f"])
    return ranked.agg(features.alias("features")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"), _FULL_JSON).alias("document"))


def event_rows(features: DataFrame) -> DataFrame:
    """Answer features to the rows of the event table; features without geometry or properties drop.

    An unknown time stays null. Depth is the third coordinate where there is one, else the property.
    """
    p, coordinates = F.col("properties"), F.col("geometry.coordinates")
    time_ms = F.coalesce(p["time_ms"], p["time"]) if _has_field(features, "time_ms") else p["time"]
    depth = F.when(F.size(coordinates) > 2, F.get(coordinates, F.lit(2))).when(coordinates.isNotNull(), p["depth_km"])
    kept = features.where(F.col("geometry").isNotNull() & F.col("properties").isNotNull())
    carried = [c for c in features.columns if c not in ("type", "geometry", "properties")]
    return kept.select(
        *carried,
        ms_to_datetime(numeric_coerce(time_ms)).alias("time"),
        numeric_coerce(time_ms).alias("time_ms"),
        numeric_coerce(p["mag"]).alias("mag"),
        numeric_coerce(depth).alias("depth_km"),
        numeric_coerce(F.get(coordinates, F.lit(0))).alias("lon"),
        numeric_coerce(F.get(coordinates, F.lit(1))).alias("lat"),
        F.coalesce(F.nullif(p["place"], F.lit("")), p["title"]).alias("place"),
        p["net"].alias("net"),
        p["tsunami"].alias("tsunami"),
        p["url"].alias("url"),
    )


def _has_field(df: DataFrame, name: str) -> bool:
    return name in df.schema["properties"].dataType.fieldNames()


def format_event_row(quakes: DataFrame) -> DataFrame:
    """The text cells of the map's table; depth comes from the event's own column."""
    time_ms = F.coalesce(ts_to_epoch_ms(F.col("time_utc")), F.lit(0))
    return quakes.select(
        "id",
        F.date_format(F.timestamp_millis(time_ms), "yyyy-MM-dd HH:mm:ss.SSS' Z'").alias("time_text"),
        display_place(F.col("place"), F.col("title")).alias("place_text"),
        fixed_or_dash(F.col("mag"), 1).alias("mag_text"),
        fixed_or_dash(F.col("depth_km"), 1).alias("depth_text"),
        F.coalesce(F.nullif(F.col("net"), F.lit("")), F.lit(NO_VALUE)).alias("net_text"),
        F.coalesce("tsunami", F.lit(0)).alias("tsunami"),
        fixed_or_dash(F.col("lon"), 3).alias("lon_text"),
        fixed_or_dash(F.col("lat"), 3).alias("lat_text"),
        F.coalesce(F.nullif(F.col("url"), F.lit("")), F.lit("#")).alias("url"),
    )
