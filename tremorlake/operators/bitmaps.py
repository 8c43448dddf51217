"""Bitmaps of the engine's size and layout, built word by word."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BLOCK_BITS = 32_768          # of the engine's bitmap functions
WORD_BITS = 64


def _little_endian(word: Column) -> Column:
    """The eight bytes of a word as hex text, lowest byte first."""
    high_first = F.lpad(F.hex(word), 16, "0")
    return F.concat(*[F.substring(high_first, at, 2) for at in range(15, 0, -2)])


def bitmaps(rows: DataFrame, by: Sequence[str], bit: str, out: str) -> DataFrame:
    """``(*by, out)`` with the bits of each group set, as ``bitmap_construct_agg`` gives them.

    That function sorts all rows of a task. Here a task keeps the words its rows touch, in a hash table of numbers, and
    only words are gathered.
    """
    at = F.col(bit)
    words = rows.select(*by, F.shiftright(at, 6).cast("int").alias("_w"), F.expr(f"shiftleft(1L, CAST({bit} & 63 AS INT))").alias("_m"))
    held = words.groupBy(*by, "_w").agg(F.bit_or("_m").alias("_m"))
    listed = held.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_w", "_m"))).alias("_l"))
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(F.col("_l"), i - 1)["_w"])
    gap = lambda words: F.repeat(F.lit("00"), words * (WORD_BITS // 8))
    filled = F.transform("_l", lambda e, i: F.concat(gap(e["_w"] - before(i) - 1), _little_endian(e["_m"])))
    rest = gap(F.lit(BLOCK_BITS // WORD_BITS - 1) - F.element_at("_l", -1)["_w"])
    return listed.select(*by, F.unhex(F.concat(F.array_join(filled, ""), rest)).alias(out))
