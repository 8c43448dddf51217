"""Named event sources that answer the user's query with a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tremorlake.operators.features import flatten_feature
from tremorlake.operators.filters import DEFAULT_LIMIT, EventFilter
from tremorlake.operators.ranking import query_events
from tremorlake.operators.tables import first_write_wins
from tremorlake.sources.geojson import read_feature_lines
from tremorlake.sources.store import scan_quake

Source = Callable[[SparkSession, str], DataFrame]


def _landed(spark: SparkSession, path: str) -> DataFrame:
    """Events of landed snapshots: of an event that landed several times its newest revision, numbered by a hash."""
    events = first_write_wins(flatten_feature(read_feature_lines(spark, path)), "usgs_id", [F.col("updated_utc").desc_nulls_last()])
    return events.withColumn("id", F.xxhash64(F.coalesce("usgs_id", F.to_json(F.struct(*events.columns)))))


SOURCES: dict[str, Source] = {"store": scan_quake, "landed": _landed}


def register_source(name: str, source: Source) -> None:
    SOURCES[name] = source


def answer(spark: SparkSession, source: str, path: str, wanted: EventFilter, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Run the user's query on a named source."""
    if source not in SOURCES:
        raise KeyError(f"unknown source {source!r}, known: {sorted(SOURCES)}")
    return query_events(SOURCES[source](spark, path), wanted, limit)
