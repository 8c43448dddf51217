"""Inputs that several queries share, prepared once per session and state of a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremorlake.operators.pip import PolygonIndex, build_index
from tremorlake.operators.tables import sea_lookup
from tremorlake.plans import fixtures
from tremorlake.session import pin, scratch_path
from tremorlake.sources.geojson import land_feed_snapshot


def fewer_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country layer after every seventh country left it."""
    return fixtures.country_polygons(spark, sf_dir).where("row_id % 7 <> 3")


LAYERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "country": fixtures.country_polygons,
    "fewer_countries": fewer_countries,
    "sea": fixtures.sea_polygons,
    "zone": fixtures.zone_polygons,
    "basin": fixtures.basin_polygons,
}

_prepared: dict[tuple, object] = {}


def _last_change(spark: SparkSession, sf_dir: str) -> int:
    """When a table of the folder was last written, so that changed tables are prepared anew."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    tables = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return max((t.getModificationTime() for t in tables), default=0)


def _once(spark: SparkSession, key: tuple, make: Callable[[], object]):
    full = (spark.sparkContext.applicationId, _last_change(spark, key[0]), *key)
    if full not in _prepared:
        _prepared[full] = make()
    return _prepared[full]


def polygon_index(spark: SparkSession, sf_dir: str, layer: str) -> PolygonIndex:
    return _once(spark, (sf_dir, "index", layer), lambda: build_index(LAYERS[layer](spark, sf_dir)))


def seas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, (sf_dir, "seas"), lambda: pin(sea_lookup(fixtures.sea_polygons(spark, sf_dir))))


def landed_feed(spark: SparkSession, sf_dir: str) -> str:
    """All events landed as feature lines in the shared folder."""
    def land() -> str:
        path = scratch_path(spark, "feed")
        land_feed_snapshot(fixtures.quakes(spark, sf_dir), path)
        return path

    return _once(spark, (sf_dir, "feed"), land)
