"""Country and sea of every event."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tremorlake.functions.text import clean_lookup_key
from tremorlake.operators.joins import lookup_join
from tremorlake.operators.pip import PolygonIndex, changed_cells, points_in_cells, resolve_polygon
from tremorlake.session import stage


def scan_points(quakes: DataFrame) -> DataFrame:
    """``(id, lat, lon)`` of the events that have coordinates."""
    return quakes.select("id", "lat", "lon").where("lat IS NOT NULL AND lon IS NOT NULL")


def _attach(points: DataFrame, attributes: DataFrame, key: str) -> DataFrame:
    """Attribute of the polygon found."""
    return lookup_join(points, attributes, [key]).drop(key)


def country_attributes(layer: DataFrame) -> DataFrame:
    """Polygon row id to cleaned country key."""
    return layer.select(F.col("row_id").alias("_country"), clean_lookup_key(F.col("ISO_SOV1")).alias("country_iso"))


def sea_attributes(layer: DataFrame, seas: DataFrame) -> DataFrame:
    """Polygon row id to the id its name has in the sea table."""
    named = layer.select(F.col("row_id").alias("_sea"), "name")
    return named.join(seas.select("name", F.col("id").alias("sea_id")), "name", "left").select("_sea", "sea_id")


def resolve_country(points: DataFrame, index: PolygonIndex, layer: DataFrame) -> DataFrame:
    return _attach(resolve_polygon(points, index, "_country"), country_attributes(layer), "_country")


def resolve_sea(points: DataFrame, index: PolygonIndex, layer: DataFrame, seas: DataFrame) -> DataFrame:
    return _attach(resolve_polygon(points, index, "_sea"), sea_attributes(layer, seas), "_sea")


def resolve_location(points: DataFrame, country_index: PolygonIndex, countries: DataFrame,
                     sea_index: PolygonIndex, sea_polygons: DataFrame, seas: DataFrame) -> DataFrame:
    """Country and sea side by side, each independent of the other; unresolved points stay with nulls.

    Both lookups add a column to the same stream of points: no join of events with events.
    """
    with_country = resolve_country(points, country_index, countries)
    return resolve_sea(with_country, sea_index, sea_polygons, seas)


def location_rows(resolved: DataFrame) -> DataFrame:
    return resolved.select(F.col("id").alias("quake_id"), "country_iso", F.col("sea_id").cast("int").alias("sea_id"))


def country_stats(resolved: DataFrame) -> DataFrame:
    """Events, strongest magnitude and mean depth per country and sea."""
    return resolved.groupBy("country_iso", "sea_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.max("mag").alias("max_mag"),
        F.round(F.avg("depth_km"), 6).alias("mean_depth_km"),
    )


def points_to_relocate(points: DataFrame, old_country: tuple[PolygonIndex, DataFrame], new_country: tuple[PolygonIndex, DataFrame],
                       old_sea: tuple[PolygonIndex, DataFrame, DataFrame], new_sea: tuple[PolygonIndex, DataFrame, DataFrame]) -> DataFrame:
    """The points that a change of the layers may touch: those in cells whose answer differs, in the old or the new index.

    Layers come with their index, seas with their id table as well. A polygon that moved, went, came, or carries another
    key or sea id changes the cells it meets; row ids alone change nothing.
    """
    def countries(side):
        return side[0], country_attributes(side[1]).select(F.col("_country").alias("poly"), F.col("country_iso").alias("value"))

    def seas(side):
        return side[0], sea_attributes(side[1], side[2]).select(F.col("_sea").alias("poly"), F.col("sea_id").cast("string").alias("value"))

    flagged, flags = points, []
    for n, (old, new) in enumerate(((countries(old_country), countries(new_country)), (seas(old_sea), seas(new_sea)))):
        cells = stage(changed_cells(*old, *new))
        for m, index in enumerate((old[0], new[0])):
            flagged = points_in_cells(flagged, index, cells, f"_flag{n}{m}")
            flags.append(F.col(f"_flag{n}{m}"))
    touched = flags[0] | flags[1] | flags[2] | flags[3]
    return flagged.where(touched).select(*points.columns)
