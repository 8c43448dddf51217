"""Time playback: what each frame of a replay shows, without pairing events with frames."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorlake.functions.geo import cell_index
from tremorlake.functions.styling import HEAT_FADE, age_fade, mag_weight
from tremorlake.functions.times import HOUR_MS, ts_to_epoch_ms
from tremorlake.operators.filters import within_ms

FADED_HOURS = int(HEAT_FADE[-1][0])


def _timed(quakes: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Events that show at some frame, with their time; an unknown time counts as 0."""
    return within_ms(quakes, start_ms, end_ms).withColumn("time_ms", F.coalesce(ts_to_epoch_ms(F.col("time_utc")), F.lit(0)))


def playback_counts(quakes: DataFrame, start_ms: int, end_ms: int, step_hours: int = 1) -> DataFrame:
    """Visible events at each frame ``start, start + step, ... <= end``.

    An event is counted at its first frame; the running sum is over frames, whose number depends on the
    range and the step alone.
    """
    step = step_hours * HOUR_MS
    last = (end_ms - start_ms) // step
    first_frame = F.ceil((F.col("time_ms") - start_ms) / F.lit(float(step))).cast("long")
    arrivals = _timed(quakes, start_ms, end_ms).groupBy(first_frame.alias("frame")).agg(F.count(F.lit(1)).alias("new"))
    frames = quakes.sparkSession.range(last + 1).withColumnRenamed("id", "frame")
    upto = Window.orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    return frames.join(arrivals, "frame", "left").select(
        "frame", F.timestamp_millis(F.lit(start_ms) + F.col("frame") * step).cast("timestamp_ntz").alias("frame_time"),
        F.coalesce(F.sum("new").over(upto), F.lit(0)).alias("visible"))


def _fade_slope(hours: Column) -> Column:
    """Change of the fading per hour from ``hours`` on."""
    chain = F.when(hours < HEAT_FADE[0][0], F.lit(0.0))
    for (x0, y0), (x1, y1) in zip(HEAT_FADE, HEAT_FADE[1:]):
        chain = chain.when(hours < x1, F.lit((y1 - y0) / (x1 - x0)))
    return chain.otherwise(F.lit(0.0))


def playback_heat(quakes: DataFrame, start_ms: int, end_ms: int, step_hours: int, cell_deg: float) -> DataFrame:
    """Heat per frame and grid cell, fading to nothing after 72 hours.

    Fading is linear between its stops, so the events of one cell and one short time slot add up to two
    sums: of the weights, and of the weights times the time left in the slot. Only these sums, not the
    events, are repeated over the frames that still show them. A slot divides both the step and the
    first fading stop, so no slot reaches over a stop.
    """
    stop_hours = [int(x) for x, _ in HEAT_FADE if x]
    slot_hours = gcd(step_hours, *stop_hours)
    slot, last = slot_hours * HOUR_MS, (end_ms - start_ms) // (step_hours * HOUR_MS)
    slots_per_frame = step_hours // slot_hours
    slot_no = F.ceil((F.col("time_ms") - start_ms) / F.lit(float(slot))).cast("long")
    left_hours = (F.lit(start_ms) + F.col("slot") * slot - F.col("time_ms")) / F.lit(float(HOUR_MS))
    weight = mag_weight(F.col("mag"))
    sums = (
        _timed(quakes, start_ms, end_ms).where("lon IS NOT NULL AND lat IS NOT NULL")
        .withColumn("slot", slot_no)
        .groupBy("slot", cell_index(F.col("lat"), cell_deg).alias("cell_r"),
                 cell_index(F.col("lon"), cell_deg).alias("cell_c"))
        .agg(F.sum(weight).alias("w"), F.sum(weight * left_hours).alias("wl"), F.count(F.lit(1)).alias("n"))
    )
    first = F.ceil(F.col("slot") / F.lit(float(slots_per_frame))).cast("long")
    final = F.least(F.lit(last), F.ceil(
        (F.col("slot") + F.lit(FADED_HOURS // slot_hours)) / F.lit(float(slots_per_frame))).cast("long") - 1)
    shown = sums.where(first <= final).withColumn("frame", F.explode(F.sequence(first, final)))
    age = (F.col("frame") * slots_per_frame - F.col("slot")) * F.lit(float(slot_hours))
    heat = F.col("w") * age_fade(age) + F.col("wl") * _fade_slope(age)
    return shown.groupBy("frame", "cell_r", "cell_c").agg(
        F.round(F.sum(heat), 6).alias("heat"), F.sum("n").alias("n_events"))
