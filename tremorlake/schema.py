"""Schemas of the tables and of the GeoJSON documents."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the event store and of the GeoJSON feed.
QUAKE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("usgs_id", T.StringType()),
    T.StructField("mag", T.DoubleType()),
    T.StructField("place", T.StringType()),
    T.StructField("time_utc", T.TimestampType()),
    T.StructField("updated_utc", T.TimestampType()),
    T.StructField("url", T.StringType()),
    T.StructField("detail_url", T.StringType()),
    T.StructField("tsunami", T.IntegerType()),
    T.StructField("sig", T.IntegerType()),
    T.StructField("mag_type", T.StringType()),
    T.StructField("typ", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("net", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("depth_km", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
])

COUNTRY = T.StructType([T.StructField("iso", T.StringType()), T.StructField("name", T.StringType())])
SEA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
LOCATION = T.StructType([
    T.StructField("quake_id", T.LongType()),
    T.StructField("country_iso", T.StringType()),
    T.StructField("sea_id", T.IntegerType()),
])
LOAD_LOG = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("start_time_utc", T.TimestampType()),
    T.StructField("end_time_utc", T.TimestampType()),
    T.StructField("rows_submitted", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
])
FEATURE_IN = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("geometry", GEOMETRY),
    T.StructField("properties", T.StructType([
        T.StructField("mag", T.DoubleType()),
        T.StructField("place", T.StringType()),
        T.StructField("time", T.LongType()),
        T.StructField("updated", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("tsunami", T.IntegerType()),
        T.StructField("sig", T.IntegerType()),
        T.StructField("magType", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("net", T.StringType()),
        T.StructField("code", T.StringType()),
    ])),
])
FEATURE_COLLECTION_IN = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(FEATURE_IN)),
])
FEATURE_OUT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("geometry", GEOMETRY),
    T.StructField("properties", T.StructType([
        T.StructField("time", T.LongType()),
        T.StructField("mag", T.DoubleType()),
        T.StructField("place", T.StringType()),
        T.StructField("depth_km", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("tsunami", T.IntegerType()),
        T.StructField("net", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
    ])),
])

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(VERTEX))
POLYGONS = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("srid", T.IntegerType()),
    T.StructField("rings", RINGS),
])
