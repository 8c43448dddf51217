"""Piecewise linear map styling: size, weight, colour and fading as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Stops = Sequence[tuple[float, float]]

# Fixed values: (input, output) stops of the map style. Ages are hours.
MAG_RADIUS: Stops = [(0, 3), (2, 5), (4, 8), (6, 14), (7, 20)]
MAG_WEIGHT: Stops = [(0, 0.1), (2, 0.3), (4, 0.7), (6, 1)]
HEAT_FADE: Stops = [(0, 1), (6, 0.4), (24, 0.1), (72, 0)]
CIRCLE_OPACITY: Stops = [(0, 0.9), (6, 0.4), (24, 0.1), (72, 0)]
MAG_COLOR: Sequence[tuple[float, str]] = [(0, "#4fe08a"), (3, "#ffd166"), (5, "#ef476f"), (7, "#d90429")]


def interpolate(x: Column, stops: Stops) -> Column:
    """Linear between the stops, constant outside them, null for null."""
    first, last = stops[0], stops[-1]
    chain = F.when(x <= float(first[0]), F.lit(float(first[1])))
    for (x0, y0), (x1, y1) in zip(stops, stops[1:]):
        share = (x - F.lit(float(x0))) / F.lit(float(x1 - x0))
        chain = chain.when(x <= float(x1), F.lit(float(y0)) + share * F.lit(float(y1) - float(y0)))
    return chain.when(x > float(last[0]), F.lit(float(last[1])))


def _mag(mag: Column) -> Column:
    return F.coalesce(mag, F.lit(0.0))


def mag_radius(mag: Column) -> Column:
    return interpolate(_mag(mag), MAG_RADIUS)


def mag_weight(mag: Column) -> Column:
    return interpolate(_mag(mag), MAG_WEIGHT)


def age_fade(age_hours: Column) -> Column:
    return interpolate(age_hours, HEAT_FADE)


def circle_opacity(age_hours: Column) -> Column:
    return interpolate(age_hours, CIRCLE_OPACITY)


def mag_color(mag: Column) -> Column:
    """``#rrggbb``, each channel interpolated and rounded half up."""
    channels = []
    for at in (1, 3, 5):
        stops = [(x, int(colour[at:at + 2], 16)) for x, colour in MAG_COLOR]
        level = F.floor(interpolate(_mag(mag), stops) + F.lit(0.5))
        channels.append(F.lpad(F.lower(F.hex(level.cast("long"))), 2, "0"))
    return F.concat(F.lit("#"), *channels)
