"""GeoJSON in and out: documents, and one feature per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tremorlake.operators.features import feed_feature_struct, to_feature
from tremorlake.schema import FEATURE_COLLECTION_IN, FEATURE_IN


def read_geojson_features(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Features of FeatureCollection documents; a document without features gives no rows.

    One document cannot be split, so the parallelism is one task per file: land many files. A document that is no
    JSON fails the read instead of giving no rows.
    """
    docs = spark.read.schema(FEATURE_COLLECTION_IN).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    return docs.select(F.inline("features"))


def read_feature_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Features written one per line, which splits and scales like any text file; ``unreadable_lines`` are left out."""
    return parse_features(spark.read.text(paths), "value")


def unreadable_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines ``(path, value)`` that hold something, but no feature."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    return lines.where((F.trim("value") != "") & ~readable_feature("value"))


def readable_feature(col: str) -> Column:
    """Whether a text is a JSON object with any member of a feature."""
    members = F.from_json(col, FEATURE_IN, {"mode": "PERMISSIVE"})
    whole = F.try_parse_json(col).isNotNull()
    return F.coalesce(whole & (members["id"].isNotNull() | members["geometry"].isNotNull() | members["properties"].isNotNull()), F.lit(False))


def parse_features(texts: DataFrame, col: str) -> DataFrame:
    """A column of feature texts to ``(id, geometry, properties)``; texts that are no feature are left out."""
    return texts.where(readable_feature(col)).select(F.from_json(col, FEATURE_IN).alias("f")).select("f.*")


def write_feature_lines(quakes: DataFrame, path: str) -> None:
    """Any number of answer features, one JSON text per line."""
    to_feature(quakes).select("feature").write.mode("overwrite").text(path)


def land_feed_snapshot(quakes: DataFrame, path: str, files: int | None = None) -> None:
    """Events as feed features, one per line, as a loader would land them."""
    lines = quakes.select(F.to_json(feed_feature_struct()).alias("value"))
    (lines.repartition(files) if files else lines).write.mode("append").text(path)
