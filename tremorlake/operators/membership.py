"""Which folders of a table may hold given keys: hashed bitmaps kept beside the folders.

Every folder has a blocked Bloom filter: a key falls into one of the folder's blocks, a bitmap of 32,768 bits, and sets
``HASHES`` bits in it. The number of blocks is a power of two that follows the folder's number of keys, so a folder takes
``BITS_PER_KEY`` to twice as many bits a key and about one in a hundred foreign keys is taken for possible. A key that
stands in a folder is always found: there are no false negatives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.operators.bitmaps import BLOCK_BITS, bitmaps
from tremorlake.operators.joins import MAX_COPIED_BYTES, measured_bytes

BITS_PER_KEY = 12
HASHES = 4


def _places(key: Column) -> list[Column]:
    """A hash that picks the block, and ``HASHES`` bits of it from another one."""
    bits = F.xxhash64(key, F.lit(1))
    return [F.xxhash64(key, F.lit(0)).alias("_h"), *[
        F.shiftrightunsigned(bits, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).alias(f"_b{i}") for i in range(HASHES)]]


def key_filters(rows: DataFrame, key: Column, folder: Sequence[str]) -> DataFrame:
    """``(*folder, blocks, block, bits)`` for every folder of ``rows``; rows without a key are in no filter."""
    keyed = rows.select(*folder, key.alias("_key")).where("_key IS NOT NULL")
    wanted = F.ceil(F.log2(F.count(F.lit(1)) * BITS_PER_KEY / BLOCK_BITS))
    sizes = keyed.groupBy(*folder).agg(F.pow(F.lit(2.0), F.greatest(wanted, F.lit(0))).cast("long").alias("blocks"))
    # hashes scatter a folder's keys over all its blocks, so keys move to their block before their bits are collected
    parted = keyed.select(*folder, *_places(F.col("_key"))).join(sizes, list(folder)).withColumn(
        "block", F.col("_h").bitwiseAND(F.col("blocks") - 1)).drop("_h").repartition(*folder, "blocks", "block")
    placed = parted.select(*folder, "blocks", "block", F.explode(F.array(*[f"_b{i}" for i in range(HASHES)])).alias("_bit"))
    return bitmaps(placed, [*folder, "blocks", "block"], "_bit", "bits")


def _is_set(bits: str, at: str) -> str:
    return f"(cast(conv(hex(substring({bits}, cast({at} div 8 as int) + 1, 1)), 16, 10) as int) >> cast({at} % 8 as int)) & 1 = 1"


def possible_folders(filters: DataFrame, keys: DataFrame, key: str, folder: Sequence[str], max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """The distinct folders whose filter may hold one of ``keys``.

    A few keys go to the filters, which are tested where they lie; for many keys both sides move by block.
    """
    sizes = [r["blocks"] for r in filters.select("blocks").distinct().collect()]        # powers of two, so a few dozen
    if not sizes:
        return filters.select(*folder)
    probes = keys.where(F.col(key).isNotNull()).select(*_places(F.col(key))).distinct().withColumn(
        "blocks", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes]))).withColumn("block", F.col("_h").bitwiseAND(F.col("blocks") - 1))
    small = measured_bytes(probes) <= max_copied
    met = filters.join(F.broadcast(probes) if small else probes, ["blocks", "block"])
    held = F.expr(" AND ".join(_is_set("bits", f"_b{i}") for i in range(HASHES)))
    return met.where(held).select(*folder).distinct()
