"""Summaries per period that can be stored and merged: counts, moments, extremes and a quantile sketch.

A range of time is described from the stored summaries of the whole periods inside it; only the rows of the two broken
periods at its ends are read. Counts, mean, deviation and extremes are exact up to rounding, quartiles have a rank error.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

#: Size of a sketch, and the rank error that merged sketches of this size keep below (as a share of the rows).
SKETCH_K = 800
RANK_ERROR = 0.01
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def summarize(df: DataFrame, time: str, value: str, period: str = "month", k: int = SKETCH_K) -> DataFrame:
    """``(period_start, n, mean, m2, lo, hi, sketch)`` of the known values per period; partial sums and sketches form in
    the tasks. Rows without a time are in no period."""
    x = F.col(value).cast("double")
    known = df.select(F.date_trunc(period, time).cast("timestamp_ntz").alias("period_start"), x.alias("x")).where("x IS NOT NULL AND period_start IS NOT NULL")
    return known.groupBy("period_start").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("m2"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"))


def merge_summaries(summaries: DataFrame) -> DataFrame:
    """One row ``count, mean, std, min, p25, p50, p75, max`` for all the periods given, as ``describe`` names them."""
    total = summaries.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("count"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.sum(F.col("m2") + F.col("n") * F.col("mean") * F.col("mean")).alias("squares"), F.min("lo").alias("min"), F.max("hi").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"))
    spread = F.greatest(F.col("squares") - F.col("count") * F.col("mean") * F.col("mean"), F.lit(0.0))
    some = F.col("count") > 0
    return total.select(
        "count", "mean", F.when(F.col("count") > 1, F.sqrt(spread / (F.col("count") - 1))).alias("std"), "min",
        *[F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(name) for name, q in QUARTILES.items()], "max")


def describe_range(summaries: DataFrame, df: DataFrame, time: str, value: str, start: datetime, end: datetime, period: str = "month") -> DataFrame:
    """The merged description of ``[start, end)``: whole periods from ``summaries``, the rest from the rows of ``df``."""
    low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    first = F.date_trunc(period, low).cast("timestamp_ntz")
    first = F.when(first < low, first + F.expr(f"INTERVAL '1' {period}")).otherwise(first)
    last = F.date_trunc(period, high).cast("timestamp_ntz")
    whole = summaries.where((F.col("period_start") >= first) & (F.col("period_start") < last))
    at = F.col(time)
    broken = df.where((at >= low) & (at < high) & ((at < first) | (at >= last)))
    return merge_summaries(whole.unionByName(summarize(broken, time, value, period)))
