"""First-write-wins inserts, upserts, lookups and integrity checks as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorlake.functions.text import clean_lookup_key, clean_lookup_name
from tremorlake.operators.joins import MAX_COPIED_BYTES, lookup_join, lookup_semi, measured_bytes
from tremorlake.operators.ordering import row_ids
from tremorlake.sources.polygons import COUNTRY_COLUMNS, SEA_COLUMNS, require_columns


def _earliest(keyed: DataFrame, key: str, arrival: Sequence[Column | str]) -> DataFrame:
    """First row per key; the rank filter is also applied before the shuffle, so a hot key sends one row per task."""
    w = Window.partitionBy(key).orderBy(*arrival)
    return keyed.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _with_and_without(batch: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and rows without one, which never conflict and so need no shuffle."""
    return batch.where(F.col(key).isNotNull()), batch.where(F.col(key).isNull())


def first_write_wins(batch: DataFrame, key: str, arrival: Sequence[Column | str]) -> DataFrame:
    """The earliest row of each key; rows without a key all stay."""
    keyed, keyless = _with_and_without(batch, key)
    return _earliest(keyed, key, arrival).unionByName(keyless)


def anti_existing(batch: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet. A null key never conflicts."""
    keyed, keyless = _with_and_without(batch, key)
    return keyed.join(_stored_keys(existing, keyed, key), key, "left_anti").select(*batch.columns).unionByName(keyless)


def _stored_keys(existing: DataFrame, keyed: DataFrame, key: str, max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """Stored keys that matter to a batch.

    The keys of a batch that were measured and are small go to the stored rows, which are then filtered where they lie;
    only hits move. For a large batch both sides move by key.
    """
    stored = existing.select(key)
    keys = keyed.select(key).distinct()
    if measured_bytes(keys) > max_copied:
        return stored
    return F.broadcast(stored.join(F.broadcast(keys), key, "left_semi").distinct())


def insert_new(existing: DataFrame, batch: DataFrame, arrival: Sequence[Column | str] = ("id",),
               key: str = "usgs_id") -> DataFrame:
    """The rows an insert would add: a stored key is never updated, even by a newer revision.

    A small batch is looked up in the stored rows without moving them. For a large one both steps need its rows by
    key, so one shuffle serves both.
    """
    keyed, keyless = _with_and_without(batch, key)
    new = _earliest(keyed, key, arrival).join(_stored_keys(existing, keyed, key), key, "left_anti")
    return new.select(*batch.columns).unionByName(keyless)


def dense_ids(new_rows: DataFrame, max_id: int | Column, out: str = "id") -> DataFrame:
    """Surrogate ids above ``max_id`` in the order of time; the remaining columns break ties."""
    rest = [c for c in new_rows.columns if c not in ("time_utc", "usgs_id")]
    first = (max_id if isinstance(max_id, Column) else F.lit(max_id)) + 1
    return row_ids(new_rows, ["time_utc", "usgs_id", *rest], first, out)


def country_lookup(layer: DataFrame) -> DataFrame:
    """``(iso, name)``: cleaned, rows without either dropped, first name by row id for each key."""
    require_columns(layer, COUNTRY_COLUMNS, "country")
    cleaned = layer.select("row_id", clean_lookup_key(F.col("ISO_SOV1")).alias("iso"),
                           clean_lookup_name(F.col("SOVEREIGN1")).alias("name")).dropna(subset=["iso", "name"])
    return cleaned.groupBy("iso").agg(F.min_by("name", "row_id").alias("name"))


def sea_lookup(layer: DataFrame) -> DataFrame:
    """``(id, name)``: distinct names numbered from 0 in order of first appearance."""
    require_columns(layer, SEA_COLUMNS, "sea")
    firsts = layer.where("name IS NOT NULL").groupBy("name").agg(F.min("row_id").alias("first_row"))
    return row_ids(firsts, ["first_row"], 0, "id").select(F.col("id").cast("int").alias("id"), "name")


def upsert_country(stored: DataFrame, new: DataFrame) -> DataFrame:
    """New names replace stored ones; other countries stay."""
    require_columns(new, ("iso", "name"), "country")
    merged = stored.select("iso", F.col("name").alias("old")).join(new.select("iso", F.col("name").alias("new")), "iso", "full_outer")
    return merged.select("iso", F.coalesce("new", "old").alias("name"))


def upsert_sea(stored: DataFrame, new: DataFrame) -> DataFrame:
    """As for countries, by id; a name under two ids fails while the rows are read."""
    merged = stored.select("id", F.col("name").alias("old")).join(new.select("id", F.col("name").alias("new")), "id", "full_outer")
    rows = merged.select("id", F.coalesce("new", "old").alias("name"))
    uses = rows.groupBy("name").agg(F.min("id").alias("id"), F.max("id").alias("other"))
    clash = F.raise_error(F.concat(F.lit("sea name under two ids: "), F.col("name")))
    return uses.select(F.when(F.col("id") == F.col("other"), F.col("id")).otherwise(clash.cast("int")).alias("id"), "name")


def fill_all(countries: DataFrame, seas: DataFrame, country_layer: DataFrame, sea_layer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both lookup tables after an upsert from their polygon layers."""
    return upsert_country(countries, country_lookup(country_layer)), upsert_sea(seas, sea_lookup(sea_layer))


def upsert_location(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The new row of an event replaces the stored one, nulls included."""
    kept = stored.join(new.select("quake_id"), "quake_id", "left_anti")
    return kept.select("quake_id", "country_iso", "sea_id").unionByName(new.select("quake_id", "country_iso", "sea_id"))


def unresolved_points(points: DataFrame, location: DataFrame, block_ids: int = 1_000_000, max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """Events with coordinates and no location row yet.

    Ids are compared by blocks first: a block in which both sides have the same number of ids and the same
    combined hash is done. Only the other blocks, as a rule those of the last loads, take part in the join by id.
    """
    block = F.coalesce(F.floor(F.col("id") / block_ids).cast("long"), F.lit(-1))
    located = location.select(F.col("quake_id").alias("id"))

    def marks(df: DataFrame) -> DataFrame:
        return df.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("mark"))

    same = marks(located).withColumnsRenamed({"n": "m", "mark": "other"})
    open_blocks = marks(points).join(same, "_block", "left").where(
        F.col("m").isNull() | (F.col("n") != F.col("m")) | (F.col("mark") != F.col("other"))).select("_block")
    todo = lookup_semi(points.withColumn("_block", block), open_blocks, ["_block"], max_copied)
    rest = lookup_semi(located.withColumn("_block", block), open_blocks, ["_block"], max_copied)
    return todo.drop("_block").join(rest.select("id"), "id", "left_anti")


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and null if it occurs, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def check_references(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values of ``column`` with no parent, and how many rows use them; null is allowed.

    Equal values are counted before the join, so a hot value is one row.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("missing")).agg(
        F.count(F.lit(1)).alias("n"))
    return used.join(parent.select(F.col(key).alias("missing")), "missing", "left_anti")


def delete_cascade(location: DataFrame, deleted_quakes: DataFrame) -> DataFrame:
    """Locations that remain after events are deleted."""
    return location.join(deleted_quakes.select(F.col("id").alias("quake_id")), "quake_id", "left_anti")


def delete_set_null(location: DataFrame, column: str, deleted: DataFrame, key: str) -> DataFrame:
    """Locations after countries or seas are deleted: their references become null.

    Deleted keys are distinct, so the join adds no rows.
    """
    gone = deleted.select(F.col(key).alias(column)).distinct().withColumn("_gone", F.lit(True))
    joined = lookup_join(location, gone, [column])
    cleared = F.when(F.col("_gone").isNull(), F.col(column)).alias(column)
    return joined.select(*[cleared if c == column else c for c in location.columns])
