"""Total orders and running sums over data of any size, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorlake.session import stage

_POSITION_BITS = 33   # monotonically_increasing_id keeps the row number in the low 33 bits


def ranged(df: DataFrame, keys: list[Column | str], partitions: int | None = None) -> DataFrame:
    """Sort by ``keys`` across range partitions; adds ``_part`` and the 0-based ``_pos`` inside it.

    The result is a written table: another run could sample other range bounds. Give keys that are unique
    together, so that no hot value has to stay in one partition. Without a number of partitions the
    engine merges small ranges at run time, which keeps their order.
    """
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ordered = spread.sortWithinPartitions(*keys)
    numbered = ordered.withColumn("_row", F.monotonically_increasing_id())
    return stage(numbered.select(
        *df.columns,
        F.shiftright("_row", _POSITION_BITS).cast("int").alias("_part"),
        F.col("_row").bitwiseAND(F.lit(2 ** _POSITION_BITS - 1)).alias("_pos"),
    ))


def _offsets(per_part: DataFrame) -> DataFrame:
    """Sum of ``_total`` over earlier partitions; one row per range partition."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))


def row_ids(df: DataFrame, keys: list[Column | str], first: int | Column, out: str = "row_id",
            partitions: int | None = None) -> DataFrame:
    """Consecutive numbers from ``first`` in the order of ``keys``: one range shuffle, no window over rows."""
    rows = ranged(df, keys, partitions)
    offsets = _offsets(rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_total")))
    start = first if isinstance(first, Column) else F.lit(first)
    # One offset per range partition, so the small side is bounded by the partition count.
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (start.cast("long") + F.col("_before") + F.col("_pos")).alias(out))


def running_total(df: DataFrame, keys: list[Column | str], value: str, out: str = "running",
                  partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in the order of ``keys``; windows span one range partition."""
    rows = ranged(df, keys, partitions)
    offsets = _offsets(rows.groupBy("_part").agg(F.sum(value).alias("_total")))
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.sum(value).over(inside)).alias(out))
