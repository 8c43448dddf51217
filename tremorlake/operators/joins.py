"""Lookup joins: copy a side whose size was measured, otherwise shuffle and let hot partitions be split at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_COPIED_BYTES = 16 << 20      # of a side that may be copied to every executor; the driver holds it several times over


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the values of ``df`` take: an aggregation that moves one number per task."""
    def size(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 8
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 8
        return F.lit(8)

    row = F.lit(8).cast("long")
    for field in df.schema.fields:
        row = row + size(field)
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def shuffled_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join by shuffle. The engine measures the partitions and splits those that a hot key of ``left`` fills.

    Only the part of ``right`` that meets a split partition is read again; without skew nothing is copied. Rows with
    a null key match nothing, and stay out of the shuffle.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    more = [c for c in right.columns if c not in keys]
    met = left.where(known).join(right.hint("merge"), keys, "left").select(*left.columns, *more)
    alone = left.where(~known).select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in more])
    return met.unionByName(alone)


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """Left join of events with a lookup table of any size, which is copied only after its bytes were measured."""
    if measured_bytes(right) <= max_copied:
        return left.join(F.broadcast(right), keys, "left").select(
            *left.columns, *[c for c in right.columns if c not in keys])
    return shuffled_left_join(left, right, keys)


def lookup_semi(left: DataFrame, right: DataFrame, keys: list[str], max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """Rows of ``left`` whose keys stand in ``right``, which is copied only after its bytes were measured."""
    if measured_bytes(right) <= max_copied:
        return left.join(F.broadcast(right), keys, "left_semi")
    return left.join(right, keys, "left_semi")
