"""Substring search by trigrams: bitmaps beside the events tell which of them can hold a text.

The index has a row per trigram and block of ids. Its bitmap has one bit per ``IDS_PER_BIT`` neighbouring ids, set where
the place or the title of one of them holds the trigram. A text can only stand where all of its trigrams do, so the
bitmaps of a block are intersected and the events left are compared with the text itself. No hit is missed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.functions.text import search_terms
from tremorlake.operators.bitmaps import bitmaps
from tremorlake.operators.filters import text_contains
from tremorlake.operators.joins import MAX_COPIED_BYTES, lookup_join

GRAM = 3
IDS_PER_BIT = 16


def _bit_number() -> Column:
    return F.floor(F.col("id") / IDS_PER_BIT).cast("long")


def _grams(text: Column) -> Column:
    """The trigrams of a text in lower case; none of a shorter or null one."""
    letters = F.lower(text)
    return F.when(F.length(letters) >= GRAM, F.transform(
        F.sequence(F.lit(1), F.length(letters) - (GRAM - 1)), lambda i: F.substring(letters, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>"))


def _present(grams: Column) -> Column:
    return F.coalesce(grams, F.array().cast("array<string>"))


def text_index(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, gram, block, ids)`` of the events' places and titles, in ranges of trigrams and so ready to be written.

    ``by`` are columns that partition the events, as ``event_month``: a search then reads only partitions with a
    candidate. Events without an id are in no bitmap; ``search_text`` compares each of them.
    """
    said = F.array_distinct(F.concat(_present(_grams(F.col("place"))), _present(_grams(F.col("title")))))
    held = events.where("id IS NOT NULL").select(
        *by, F.bitmap_bucket_number(_bit_number()).alias("block"), F.bitmap_bit_position(_bit_number()).alias("_bit"), F.explode(said).alias("gram"))
    return bitmaps(held, [*by, "gram", "block"], "_bit", "ids").repartitionByRange("gram", "block").sortWithinPartitions("gram", "block")


def _candidates(index: DataFrame, grams: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Blocks that hold all trigrams, with the bits that do; a group is one row per trigram at most."""
    found = index.where(F.col("gram").isin(list(grams))).groupBy(*by, "block").agg(
        F.count(F.lit(1)).alias("_n"), F.bitmap_and_agg("ids").alias("_ids"))
    return found.where((F.col("_n") == len(grams)) & (F.bitmap_count("_ids") > 0)).drop("_n")


def search_text(events: DataFrame, index: DataFrame, query: str, by: Sequence[str] = (), max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """The events that ``filters.text_contains`` keeps, found through the index; a blank text keeps all.

    A text of fewer than three letters has no trigram and is looked for in every event.
    """
    wanted = text_contains(query)
    if wanted is None:
        return events
    (term,) = search_terms(query)
    grams = sorted({term[i:i + GRAM] for i in range(len(term) - GRAM + 1)})
    if not grams:
        return events.where(wanted)
    placed = events.where("id IS NOT NULL").withColumns({
        "block": F.bitmap_bucket_number(_bit_number()), "_bit": F.bitmap_bit_position(_bit_number())})
    met = lookup_join(placed, _candidates(index, grams, by), [*by, "block"], max_copied)
    byte = F.conv(F.hex(F.substring("_ids", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    possible = met.where(F.col("_ids").isNotNull() & (F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1))
    return possible.where(wanted).select(*events.columns).unionByName(events.where("id IS NULL").where(wanted))
