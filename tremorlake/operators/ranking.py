"""Orders and top-k. Ties are broken by id, so every run gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.functions.geo import haversine_km
from tremorlake.operators.filters import DEFAULT_LIMIT, EventFilter


def newest_k(quakes: DataFrame, k: int = DEFAULT_LIMIT) -> DataFrame:
    return quakes.orderBy(F.col("time_utc").desc_nulls_first(), F.col("id")).limit(k)


def query_events(quakes: DataFrame, wanted: EventFilter, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The user's query: all filters, newest first, at most ``limit`` events."""
    return newest_k(wanted.apply(quakes), limit)


def strongest_k(quakes: DataFrame, k: int) -> DataFrame:
    return quakes.orderBy(F.col("mag").desc_nulls_last(), F.col("id")).limit(k)


def nearest_k(quakes: DataFrame, lon: float, lat: float, k: int) -> DataFrame:
    """The ``k`` events nearest to a place, with their distance in km."""
    km = F.round(haversine_km(F.lit(float(lon)), F.lit(float(lat)), F.col("lon"), F.col("lat")), 3)
    located = quakes.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    return located.withColumn("km", km).orderBy("km", "id").limit(k)


def table_sorted(events: DataFrame, time: str = "time") -> DataFrame:
    """Oldest first, unknown times last. The id in the sort key lets equal times span partitions."""
    return events.orderBy(F.col(time).asc_nulls_last(), F.col("id"))


def map_table_sorted(events: DataFrame, time_ms: Column) -> DataFrame:
    """Newest first, an unknown time counting as 0."""
    return events.orderBy(F.coalesce(time_ms, F.lit(0)).desc(), F.col("id"))
