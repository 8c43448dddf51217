"""Event and polygon views derived from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tremorlake.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table, derived row by row from ``events``."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "concat('ev', CAST(CASE WHEN event_id % 50 = 1 THEN event_id - 1 ELSE event_id END AS STRING)) AS usgs_id",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(floor(least(value, 240.0D) * 4) AS DOUBLE) / 100 END AS mag",
        "CASE WHEN event_id % 53 = 0 THEN NULL ELSE concat(get_json_object(props, '$.k'), ' km NE of NATION_', "
        "CAST(user_id % 25 AS STRING)) END AS place",
        "ts AS time_utc",
        "concat('https://example.org/ev', CAST(event_id AS STRING)) AS url",
        "CAST(CASE WHEN event_id % 61 = 0 THEN NULL WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS INT) AS tsunami",
        "concat(event_type, ' quake, NATION_', CAST(user_id % 25 AS STRING)) AS title",
        "CASE event_type WHEN 'click' THEN 'us' WHEN 'view' THEN 'AK' WHEN 'error' THEN 'pr' "
        "WHEN 'signup' THEN 'ci' ELSE 'nn' END AS net",
        "CASE WHEN event_id % 89 = 0 THEN NULL "
        "ELSE CAST(CAST(get_json_object(props, '$.k') AS INT) * 7 - 5 AS DOUBLE) END AS depth_km",
        "CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST((event_id * 7919) % 3601 AS DOUBLE) / 10 - 180 END AS lon",
        "CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST((event_id * 104729) % 1701 AS DOUBLE) / 10 - 85 END AS lat",
    )


def _rings(x: Column, y: Column, shapes: Sequence[Sequence[tuple[float, float]]]) -> Column:
    """Rings of the given corner offsets around (x, y)."""
    return F.array(*[
        F.array(*[
            F.struct((x + float(dx)).cast("double").alias("x"), (y + float(dy)).cast("double").alias("y"))
            for dx, dy in ring
        ]) for ring in shapes
    ])


# Corner offsets of the test polygons.
ARROW = [[(-34, -12), (40, -12), (10, 0), (40, 12), (-34, 12)]]
HOLED_STRIP = [[(0, -80), (72, -80), (72, 80), (0, 80)], [(26, -10), (46, -10), (46, 10), (26, 10)]]
SMALL_ARROW = [[(-4, -2), (5, -2), (1, 0), (5, 2), (-4, 2)]]
HOLED_SQUARE = [[(-2, -2), (2, -2), (2, 2), (-2, 2)], [(-1, -1), (1, -1), (1, 1), (-1, 1)]]


def country_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 slightly overlapping concave arrows, one per nation."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.cast("long").alias("row_id"),
        F.lit(4326).alias("srid"),
        F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("ISO_SOV1"),
        F.col("n_name").alias("SOVEREIGN1"),
        _rings(F.lit(-144) + 72 * (key % 5), F.lit(-60) + 30 * ((key - key % 5) / 5), ARROW).alias("rings"),
    )


def sea_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 rectangles that share borders, each with a hole, one per region."""
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        key.cast("long").alias("row_id"),
        F.lit(4326).alias("srid"),
        F.col("r_name").alias("name"),
        _rings(F.lit(-180) + 72 * key, F.lit(0), HOLED_STRIP).alias("rings"),
    )


def zone_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small arrow per supplier: a country layer that grows with the data and repeats its keys.

    Some keys and names are blank or stand for "no value", as raw attribute tables have them.
    """
    key = F.col("s_suppkey")
    iso = F.when(key % 11 == 0, F.lit(" na ")).when(key % 13 == 0, F.lit("")).otherwise(
        F.concat(F.lit(" n"), F.lpad((key % 40).cast("string"), 2, "0")))
    return table(spark, sf_dir, "supplier").select(
        key.alias("row_id"),
        F.lit(4326).alias("srid"),
        iso.alias("ISO_SOV1"),
        F.when(key % 17 == 0, F.lit("NONE")).otherwise(F.concat(F.lit(" "), F.col("s_name"))).alias("SOVEREIGN1"),
        _rings(F.lit(-170) + (key * 37) % 340, F.lit(-80) + (key * 53) % 160, SMALL_ARROW).alias("rings"),
    )


def basin_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small holed square per customer: a sea layer that grows with the data and repeats its names."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("row_id"),
        F.lit(4326).alias("srid"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), ((key * 7) % 90).cast("string")).alias("name"),
        _rings(F.lit(-170) + (key * 41) % 340, F.lit(-80) + (key * 59) % 160, HOLED_SQUARE).alias("rings"),
    )


def watched_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place per supplier, ``(place, lon, lat)``."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("place"), (F.lit(-170) + (key * 37) % 340).cast("double").alias("lon"),
        (F.lit(-80) + (key * 53) % 160).cast("double").alias("lat"))


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load per event: a source, a start to the second and a length in minutes; some loads failed."""
    start = F.date_trunc("second", "ts").cast("timestamp_ntz")
    minutes = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), start.alias("start_time_utc"),
        F.timestamp_add("MINUTE", minutes, start).alias("end_time_utc"),
        F.when(F.col("value") > 100, F.lit("error")).otherwise(F.lit("success")).alias("status"))
