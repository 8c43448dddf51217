"""Text rules for places, lookups and numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tremorlake.functions.times import NO_VALUE

# Texts that stand for "no value" in lookup attributes.
MISSING_TEXTS = ["", "NONE", "NA", "N/A"]


def display_place(place: Column, title: Column) -> Column:
    """The place, else the title, else a dash; empty text counts as missing."""
    return F.coalesce(F.nullif(place, F.lit("")), F.nullif(title, F.lit("")), F.lit(NO_VALUE))


NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?(inf|infinity|nan)\s*$"


def numeric_coerce(value: Column) -> Column:
    """A number, or null when the value does not parse as one; a type suffix as in ``1d`` is no part of a number."""
    return F.when(value.cast("string").rlike(NUMBER), value.try_cast("double"))


def clean_lookup_name(name: Column) -> Column:
    """Text without outer white space of any kind, null for the texts that mean "no value"."""
    trimmed = F.regexp_replace(name, r"(?U)^\s+|\s+$", "")
    return F.when(trimmed.isin(MISSING_TEXTS), F.lit(None)).otherwise(trimmed)


def clean_lookup_key(key: Column) -> Column:
    """As the name, in upper case."""
    return clean_lookup_name(F.upper(key))


def search_terms(*entries: str | None, separator: str | None = None) -> list[str]:
    """What a user typed, as different terms in the order typed: outer white space and letter case do not count.

    With a ``separator`` every entry may hold several terms; blank ones are none.
    """
    typed = separator.join(e or "" for e in entries).split(separator) if separator else entries
    terms = dict.fromkeys((e or "").strip().lower() for e in typed)
    terms.pop("", None)
    return list(terms)


def fixed_or_dash(value: Column, decimals: int) -> Column:
    """A number with fixed decimals, a dash for null. Exact halves round away from zero.

    ``format_number`` rounds the exact double but sends halves to even; a half with ``d`` decimals is an
    odd multiple of ``1 / 2**(d + 1)`` and is nudged outwards first.
    """
    scaled = value * F.lit(float(2 ** (decimals + 1)))
    is_half = (scaled == F.floor(scaled)) & (F.abs(scaled) % 2 == 1)
    nudged = F.when(is_half, value + F.signum(value) * F.lit(1e-6)).otherwise(value)
    pattern = F.lit("0." + "0" * decimals)
    return F.coalesce(F.call_function("format_number", nudged, pattern), F.lit(NO_VALUE))
