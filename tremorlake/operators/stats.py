"""Counts, histograms, summary statistics and heat grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.functions.geo import cell_index
from tremorlake.functions.styling import HEAT_FADE, age_fade, mag_weight
from tremorlake.functions.times import HOUR_MS, ts_to_epoch_ms
from tremorlake.operators.filters import since
from tremorlake.operators.ordering import running_total

SINGLE_VALUE_STEP = 0.001         # bin width where all values are equal
QUARTILES = (0.25, 0.5, 0.75)
MAX_COUNTED_VALUES = 200_000      # distinct values one task may hold to find the quartiles


def count_quakes(quakes: DataFrame) -> DataFrame:
    return quakes.agg(F.count(F.lit(1)).alias("n"))


def needs_initial_load(quakes: DataFrame) -> bool:
    """True for an empty store; looks for one row instead of counting."""
    return quakes.isEmpty()


def histogram(df: DataFrame, col: str, maxbins: int, log_scale: bool = False) -> DataFrame:
    """Bins ``(bin, bin_start, bin_end, count)`` of the smallest step that needs at most ``maxbins``.

    Steps are 1, 2 or 5 times a power of ten, found around the decade of range / maxbins, so no range is too small
    or too large for them. The step is a scalar subquery over the value range: one plan serves both passes.
    """
    known = df.select(F.col(col).alias("x")).where("x IS NOT NULL")
    width = F.col("hi") - F.col("lo")
    decade = F.floor(F.log10(width / F.lit(float(maxbins)))).cast("int")

    def power(k: Column) -> Column:
        # quotients of whole numbers are the doubles nearest to 0.001, 0.002, ..
        ten = F.pow(F.lit(10.0), F.abs(k))
        return F.array(*[F.when(k < 0, F.lit(m) / ten).otherwise(F.lit(m) * ten) for m in (1.0, 2.0, 5.0)])

    steps = F.flatten(F.transform(F.sequence(decade - 1, decade + 1), power))
    fitting = F.get(F.filter(steps, lambda s: width / s <= F.lit(float(maxbins))), F.lit(0))
    step = known.agg(F.min("x").cast("double").alias("lo"), F.max("x").cast("double").alias("hi")).select(
        F.when(width > 0, fitting).otherwise(F.lit(SINGLE_VALUE_STEP))).scalar()
    bins = known.select(step.alias("step"), F.floor(F.col("x") / step).cast("long").alias("bin"))
    counted = bins.groupBy("bin", "step").agg(F.count(F.lit(1)).alias("count"))
    out = counted.select(
        "bin", _edge(F.col("bin"), F.col("step")).alias("bin_start"), _edge(F.col("bin") + 1, F.col("step")).alias("bin_end"), "count")
    return out.withColumn("log_count", F.round(F.log10("count"), 6)) if log_scale else out


def _edge(bin_: Column, step: Column) -> Column:
    """Border of a bin, rounded where the step allows."""
    return F.when(step >= 1e-4, F.round(bin_ * step, 6)).otherwise(bin_ * step)


def describe(df: DataFrame, col: str, max_counted: int = MAX_COUNTED_VALUES) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact interpolated quartiles, as one row.

    Equal values are counted first, so the quartiles are read from distinct values. Few of them are
    ranked in one task; many are ranked across range partitions.
    """
    known = df.select(F.col(col).cast("double").alias("x")).where("x IS NOT NULL")
    basic = known.agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.approx_count_distinct("x", 0.02).alias("kinds"),
    ).first()
    values = known.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    if basic["kinds"] <= max_counted:
        points = F.percentile("x", list(QUARTILES), F.col("n"))
        quartiles = values.agg(points.alias("q")).select(*[F.get("q", F.lit(i)).alias(f"q{i}") for i in range(3)])
    else:
        quartiles = _ranked_quartiles(values, basic["n"])
    number = lambda name: F.lit(basic[name]).cast("double")
    return quartiles.select(
        F.lit(basic["n"]).cast("long").alias("count"),
        F.round(number("mean"), 6).alias("mean"), F.round(number("std"), 6).alias("std"),
        number("lo").alias("min"),
        *[F.round(f"q{i}", 6).alias(name) for i, name in enumerate(("p25", "p50", "p75"))],
        number("hi").alias("max"))


def _ranked_quartiles(values: DataFrame, n: int) -> DataFrame:
    ranked = running_total(values, ["x"], "n", "upto")
    at = [q * (n - 1) for q in QUARTILES]
    picks = []
    for i, position in enumerate(at):
        for side, rank in (("lo", int(position)), ("hi", min(int(position) + 1, n - 1))):
            picks.append(F.min(F.when(F.col("upto") > rank, F.col("x"))).alias(f"{side}{i}"))
    row = ranked.agg(*picks)
    return row.select(*[
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.lit(position - int(position))).alias(f"q{i}")
        for i, position in enumerate(at)])


def age_hours(now: Column, time: Column) -> Column:
    return (ts_to_epoch_ms(now) - ts_to_epoch_ms(time)) / F.lit(float(HOUR_MS))


def heat_density(quakes: DataFrame, now: Column, cell_deg: float) -> DataFrame:
    """Magnitude weight times age fading, summed per grid cell.

    Only events that still show take part: not after ``now``, and not yet faded to nothing.
    """
    seen = since(quakes.where("lon IS NOT NULL AND lat IS NOT NULL"), now, int(HEAT_FADE[-1][0]))
    heat = mag_weight(F.col("mag")) * age_fade(age_hours(now, F.col("time_utc")))
    return seen.groupBy(
        cell_index(F.col("lat"), cell_deg).alias("cell_r"), cell_index(F.col("lon"), cell_deg).alias("cell_c"),
    ).agg(F.round(F.sum(heat), 6).alias("heat"), F.count(F.lit(1)).alias("n_events"))


def frequency_grid(quakes: DataFrame, now: Column, hours: int, cell_deg: float) -> DataFrame:
    """Events per grid cell in the ``hours`` up to ``now``."""
    return since(quakes, now, hours).where("lon IS NOT NULL AND lat IS NOT NULL").groupBy(
        cell_index(F.col("lat"), cell_deg).alias("cell_r"), cell_index(F.col("lon"), cell_deg).alias("cell_c"),
    ).agg(F.count(F.lit(1)).alias("n_events"))


def counts_per_hour(quakes: DataFrame) -> DataFrame:
    """Events per hour between the first and the last event, empty hours with 0.

    Hours come from a sequence over the months of the range and one over the hours of each month, so their number does
    not grow with the events and no array holds more than a month.
    """
    timed = quakes.select(F.window("time_utc", "1 hour").start.alias("hour")).where("hour IS NOT NULL")
    counts = timed.groupBy("hour").agg(F.count(F.lit(1)).alias("found"))
    span = counts.agg(F.min("hour").alias("a"), F.max("hour").alias("b")).where("a IS NOT NULL")
    months = span.select("a", "b", F.explode(F.sequence(
        F.date_trunc("month", "a"), F.date_trunc("month", "b"), F.expr("INTERVAL '1' MONTH"))).alias("month"))
    first, last = F.greatest("a", F.col("month").cast(span.schema["a"].dataType)), F.least(
        "b", (F.add_months("month", 1).cast(span.schema["a"].dataType) - F.expr("INTERVAL '1' HOUR")))
    hours = months.select(F.explode(F.sequence(first, last, F.expr("INTERVAL '1' HOUR"))).alias("hour"))
    return hours.join(counts, "hour", "left").select("hour", F.coalesce("found", F.lit(0)).alias("n_events"))
