"""Polygon layers: a row per polygon with its rings, read from Parquet or GeoJSON, and their edges.

Coordinates are planar WGS84 degrees. A polygon that crosses the antimeridian must arrive split, parts
of one polygon must not overlap and rings must not cross (even-odd rule, holes are further rings).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

COUNTRY_COLUMNS = ("ISO_SOV1", "SOVEREIGN1")
SEA_COLUMNS = ("name",)
WGS84 = 4326


def require_columns(df: DataFrame, wanted: Sequence[str], layer: str) -> DataFrame:
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise KeyError(f"{layer} layer lacks the columns {missing}")
    return df


def _checked(df: DataFrame, extra: Sequence[str], layer: str) -> DataFrame:
    """Columns are asserted while planning, the SRID and a present row id while the rows are read."""
    require_columns(df, ["row_id", "srid", "rings", *extra], layer)
    bad = F.raise_error(F.concat(F.lit(f"{layer} layer needs row_id and SRID {WGS84}, got "), F.to_json(F.struct("row_id", "srid"))))
    ok = F.coalesce((F.col("srid") == WGS84) & F.col("row_id").isNotNull(), F.lit(False))
    return df.withColumn("srid", F.when(ok, F.col("srid")).otherwise(bad.cast("int")))


def country_layer(df: DataFrame) -> DataFrame:
    return _checked(df, COUNTRY_COLUMNS, "country")


def sea_layer(df: DataFrame) -> DataFrame:
    return _checked(df, SEA_COLUMNS, "sea")


def union_layers(parts: Sequence[DataFrame]) -> DataFrame:
    """All files of a layer; columns a file lacks are null. ``row_id`` carries the order."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


def _read(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    chosen = [paths] if isinstance(paths, str) else list(paths)
    if all(p.endswith((".json", ".geojson", ".geojsonl", ".ndjson")) for p in chosen):
        return read_geojson_polygons(spark, chosen)
    return _named(spark.read.option("mergeSchema", "true").parquet(*chosen))


def _named(df: DataFrame) -> DataFrame:
    """Columns under the names used here: ``NAME`` in any case, ``__row_id__`` as ``row_id``."""
    wanted = {c.lower(): c for c in ("row_id", "srid", "rings", *COUNTRY_COLUMNS, *SEA_COLUMNS)} | {"__row_id__": "row_id"}
    taken = set(df.columns)
    renames = {c: wanted[c.lower()] for c in df.columns if c.lower() in wanted and wanted[c.lower()] not in taken}
    return df.withColumnsRenamed(renames)


def read_country_polygons(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return country_layer(_read(spark, paths))


def read_sea_polygons(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All files of a path or glob; row ids, not file order, decide."""
    return sea_layer(_read(spark, paths))


_FEATURE = "properties MAP<STRING, STRING>, geometry STRUCT<type: STRING, coordinates: STRING>"
_GEOJSON = f"type STRING, crs STRING, features ARRAY<STRUCT<{_FEATURE.replace('properties MAP', 'properties: MAP').replace('geometry STRUCT', 'geometry: STRUCT')}>>"
_POINTS = "ARRAY<ARRAY<DOUBLE>>"


def read_geojson_polygons(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """FeatureCollections of Polygon and MultiPolygon; ``row_id`` is read from the properties.

    GeoJSON is WGS84 by definition, so another ``crs`` member gives another SRID and fails the check. Files ending
    in ``.geojsonl`` or ``.ndjson`` hold one feature per line, which splits. A text that is no JSON, a geometry of
    another type and coordinates that do not parse fail the read.
    """
    lines = [p for p in paths if p.endswith((".geojsonl", ".ndjson"))]
    whole = [p for p in paths if p not in lines]
    parts = []
    if whole:
        docs = spark.read.schema(_GEOJSON).option("multiLine", True).option("mode", "FAILFAST").json(whole)
        wgs = F.col("crs").isNull() | F.col("crs").contains("CRS84") | F.col("crs").contains(str(WGS84))
        parts.append(docs.select(F.when(wgs, F.lit(WGS84)).otherwise(F.lit(0)).alias("srid"), F.inline("features")))
    if lines:
        each = spark.read.schema(_FEATURE).option("mode", "FAILFAST").json(lines)
        parts.append(each.select(F.lit(WGS84).alias("srid"), "properties", "geometry"))
    feats = union_layers(parts)
    text, kind = F.col("geometry.coordinates"), F.col("geometry.type")
    single = F.from_json(text, f"ARRAY<{_POINTS}>")
    multi = F.flatten(F.from_json(text, f"ARRAY<ARRAY<{_POINTS}>>"))
    broken = F.raise_error(F.concat(F.lit("no polygon: "), F.coalesce(F.substring(F.to_json("geometry"), 1, 200), F.lit("null"))))
    rings = F.coalesce(F.when(kind == "Polygon", single).when(kind == "MultiPolygon", multi), broken.cast(f"ARRAY<{_POINTS}>"))
    points = F.transform(rings, lambda ring: F.transform(
        ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    props = F.transform_keys("properties", lambda k, _: F.lower(k))
    return feats.select(
        F.coalesce(props["row_id"], props["__row_id__"]).cast("long").alias("row_id"),
        "srid", points.alias("rings"),
        *[props[c.lower()].alias(c) for c in (*COUNTRY_COLUMNS, *SEA_COLUMNS)],
    )


def _closed_edges(ring: Column) -> Column:
    """Edges of one ring; the last vertex joins the first."""
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def polygon_edges(layer: DataFrame) -> DataFrame:
    """Edges ``(poly, ring, x1, y1, x2, y2)`` of a layer; edges of no length are dropped."""
    rings = layer.select(F.col("row_id").alias("poly"), F.posexplode("rings").alias("ring", "points"))
    edges = rings.select("poly", "ring", F.inline(_closed_edges(F.col("points"))))
    return edges.where(~((F.col("x1") == F.col("x2")) & (F.col("y1") == F.col("y2"))))
