"""Events near places: a grid equi-join, then the great-circle distance."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorlake.functions.geo import EARTH_RADIUS_KM, cell_index, haversine_km
from tremorlake.operators.joins import MAX_COPIED_BYTES, lookup_join, measured_bytes
from tremorlake.session import stage

FINE_SIZES = (0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)   # degrees; each divides 360
GRID_SIZES = (0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0)   # degrees; each divides 360
KM_PER_DEGREE = 111.195


def grid_for(km: float) -> float:
    """The smallest cell at least as wide as the radius, so a place reaches few cells and few far events."""
    return next((g for g in GRID_SIZES if g * KM_PER_DEGREE >= km), GRID_SIZES[-1])


def _wrapped_column(col: Column, g: float) -> Column:
    """Grid column with 180 east folded onto 180 west."""
    n = int(360 / g)
    return (F.pmod(col + n // 2, F.lit(n)) - n // 2).cast("int")


def _reached(km: float, g: float) -> tuple[Column, Column]:
    """Rows and columns of the grid that a circle of ``km`` around (lon, lat) can reach, across the antimeridian too."""
    reach = km / EARTH_RADIUS_KM
    dlat = math.degrees(reach) + 1e-9
    polar = (F.abs("lat") + dlat) >= 90
    ratio = F.lit(math.sin(min(reach, math.pi / 2))) / F.greatest(F.cos(F.radians("lat")), F.lit(1e-12))
    dlon = F.when(polar | (ratio >= 1), F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + 1e-9)
    rows = F.sequence(cell_index(F.col("lat") - dlat, g), cell_index(F.col("lat") + dlat, g))
    cols = F.array_distinct(F.transform(
        F.sequence(cell_index(F.col("lon") - dlon, g), cell_index(F.col("lon") + dlon, g)),
        lambda c: _wrapped_column(c, g)))
    return rows, cols


def place_cells(places: DataFrame, km: float, g: float) -> DataFrame:
    """Grid cells that a circle of ``km`` around each place can reach, across the antimeridian too."""
    rows, cols = _reached(km, g)
    spanned = places.select(
        "place", F.col("lon").alias("place_lon"), F.col("lat").alias("place_lat"), F.explode(rows).alias("_r"), cols.alias("_cols"))
    return spanned.withColumn("_c", F.explode("_cols")).drop("_cols")


def _km_to(event: str) -> Column:
    return F.round(haversine_km(F.col("place_lon"), F.col("place_lat"), F.col(f"{event}.lon"), F.col(f"{event}.lat")), 3)


def _may_reach(km: float, g: float) -> Column:
    """Cells whose centre is not farther than the circle and the cell's own half extents together."""
    centre = haversine_km(F.col("place_lon"), F.col("place_lat"), (F.col("_c") + 0.5) * g, (F.col("_r") + 0.5) * g)
    return centre <= km + EARTH_RADIUS_KM * math.radians(g) + 0.001


def near_places(quakes: DataFrame, places: DataFrame, km: float,
                max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """Events within ``km`` of each place ``(place, lon, lat)``, with the distance.

    ``place`` is the id of the place; the event's own place text is left out.

    A short list of places is copied to the executors; a long one is shuffled by grid cell, hot cells
    of events spread over salts.
    """
    g = grid_for(km)
    cells = place_cells(places, km, g)
    placed = quakes.drop("place").where("lon IS NOT NULL AND lat IS NOT NULL").withColumns({
        "_r": cell_index(F.col("lat"), g), "_c": _wrapped_column(cell_index(F.col("lon"), g), g)})
    pairs = lookup_join(placed, cells, ["_r", "_c"], max_copied).where("place IS NOT NULL")
    distance = haversine_km(F.col("place_lon"), F.col("place_lat"), F.col("lon"), F.col("lat"))
    return pairs.withColumn("km", F.round(distance, 3)).where(F.col("km") <= km).drop(
        "_r", "_c", "place_lon", "place_lat")


def _in_cells(places: DataFrame, g: float) -> DataFrame:
    return places.where("place IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL").select(
        *[c for c in places.columns if c not in ("lon", "lat")], F.col("lon").alias("_lon"), F.col("lat").alias("_lat"),
        cell_index(F.col("lat"), g).alias("_r"), _wrapped_column(cell_index(F.col("lon"), g), g).alias("_c"))


def places_near_events(quakes: DataFrame, places: DataFrame, km: float, max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """As ``near_places`` for few events and any number of places, as in a stream: the events' circles are spread over
    the grid, every place stands in its one cell. The placed places are written once, so each micro-batch reads them as
    they are; a short list is copied, a long one is joined by cell.
    """
    g = grid_for(km)
    placed = stage(_in_cells(places.select("place", "lon", "lat"), g))
    located = quakes.drop("place").where("lon IS NOT NULL AND lat IS NOT NULL")
    circles = place_cells(located.select(F.struct(*located.columns).alias("place"), "lon", "lat"), km, g).withColumnRenamed("place", "_q")
    small = measured_bytes(placed) <= max_copied
    pairs = circles.join(F.broadcast(placed) if small else placed, ["_r", "_c"])
    distance = haversine_km(F.col("_lon"), F.col("_lat"), F.col("_q.lon"), F.col("_q.lat"))
    return pairs.select("place", "_q.*", F.round(distance, 3).alias("km")).where(F.col("km") <= km)


def _km_to_place() -> Column:
    return haversine_km(F.col("_lon"), F.col("_lat"), F.col("lon"), F.col("lat"))


def _in_reach(km: float) -> Column:
    """Whether the rounded ``_km_to_place`` is at most ``km``. Rounding costs more than the distance, so only pairs at the
    border are rounded.
    """
    near_row = F.abs(F.col("_lat") - F.col("lat")) <= math.degrees(km / EARTH_RADIUS_KM) + 1e-6
    return near_row & (_km_to_place() <= km + 0.001) & ((_km_to_place() <= km - 0.001) | (F.round(_km_to_place(), 3) <= km))


class WatchedPlaces:
    """Places ``(place, lon, lat)`` written once, for a stream that asks them twice: before its state and after it.

    A place may be listed with several positions; ``several`` tells whether any is, and then each row has all of them.
    """

    def __init__(self, places: DataFrame, km: float, max_copied: int = MAX_COPIED_BYTES) -> None:
        self.km, self.g = km, grid_for(km)
        listed = stage(places.where("place IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL").select("place", "lon", "lat").distinct())
        more = stage(listed.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("lon", "lat"))).alias("_spots")).where(F.size("_spots") > 1))
        self.several = not more.isEmpty()
        if self.several:
            listed = lookup_join(listed, more, ["place"], max_copied)
        self.placed = stage(_in_cells(listed, self.g))
        self.small = measured_bytes(self.placed) <= max_copied

    def _met(self, circles: DataFrame, how: str, more: Sequence[str] = ()) -> DataFrame:
        """``circles`` (events with the cells ``_r``, ``_c``) with the places they reach."""
        placed = self.placed.select("place", "_lon", "_lat", F.col("_r").alias("_pr"), F.col("_c").alias("_pc"), *more)
        same = (F.col("_r") == F.col("_pr")) & (F.col("_c") == F.col("_pc"))
        return circles.join(F.broadcast(placed) if self.small else placed, same & _in_reach(self.km), how)

    def _circles(self, events: DataFrame) -> DataFrame:
        """Each event once per grid cell that its circle can reach."""
        rows, cols = _reached(self.km, self.g)
        return events.select("*", F.explode(rows).alias("_r"), cols.alias("_cols")).withColumn("_c", F.explode("_cols")).drop("_cols")

    def events_in_reach(self, events: DataFrame, nameless: Column) -> DataFrame:
        """``events`` that reach a place, once or more. Those that are ``nameless`` come with each place they reach, as
        JSON in ``_for``; it is null for all others.
        """
        near = self._met(self._circles(events), "left_semi")
        # an event with a name meets no place here, and no two of them need the same task
        cell = F.when(nameless, F.col("_r")).otherwise(F.lit(1_000_000) + F.pmod(F.xxhash64("lon", "lat"), F.lit(4096)).cast("int"))
        asked = self._met(near.withColumn("_r", cell), "left")
        return asked.select(*events.columns, F.when(F.col("place").isNotNull(), F.to_json(F.struct("place"))).alias("_for"))

    def alerts(self, events: DataFrame) -> DataFrame:
        """Each event with the places it reaches and their distance, but those that one of its earlier positions
        ``(_lons, _lats)`` reaches. A place with several positions counts once; an event with ``_for`` is for that place.
        """
        pairs = self._met(self._circles(events), "inner", ["_spots"] if self.several else [])
        # the partition number keeps what follows out of the join: functions of arrays would take the join from generated code
        found = pairs.select(*events.columns, "place", F.round(_km_to_place(), 3).alias("km"), "_lon", "_lat",
                             *(["_spots"] if self.several else []), F.spark_partition_id().alias("_task"))
        reaches = lambda x, y, s: F.round(haversine_km(s["lon"], s["lat"], x, y), 3) <= self.km
        spots = F.array(F.struct(F.col("_lon").alias("lon"), F.col("_lat").alias("lat")))
        if self.several:
            spots = F.coalesce("_spots", spots)
            first = F.get(F.filter(spots, lambda s: reaches(F.col("lon"), F.col("lat"), s)), F.lit(0))
            found = found.where((F.col("_task") >= 0) & (F.col("_spots").isNull() | ((first["lon"] == F.col("_lon")) & (first["lat"] == F.col("_lat")))))
        before = F.exists(F.arrays_zip("_lons", "_lats"), lambda e: F.exists(spots, lambda s: reaches(e["_lons"], e["_lats"], s)))
        return found.where((F.col("_task") >= 0) & (F.col("_lons").isNull() | ~before) & (
            F.col("_for").isNull() | (F.col("_for") == F.to_json(F.struct("place"))))).drop("_task", "_lon", "_lat", "_spots", "_for", "_lons", "_lats")


def last_within_km(quakes: DataFrame, places: DataFrame, km: float, max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """The newest event within ``km`` of each place that has one.

    Events are not paired with places. Every fine grid cell answers with its newest event: where that lies within the
    circle, no other event of the cell matters. Only cells whose newest event lies outside, and is newer than what the
    place has found elsewhere, have their still newer events tested one by one.
    """
    g = next((g for g in reversed(FINE_SIZES) if g * KM_PER_DEGREE * 4 <= km), FINE_SIZES[0])
    row = F.struct("id", "time_utc", "mag", "lon", "lat")
    order = F.struct("time_utc", "id")
    timed = quakes.where("lon IS NOT NULL AND lat IS NOT NULL AND time_utc IS NOT NULL").select(
        cell_index(F.col("lat"), g).alias("_r"), _wrapped_column(cell_index(F.col("lon"), g), g).alias("_c"), order.alias("_o"), row.alias("q"))
    # the engine's estimate does not see how many cells a place is spread over, so the join is chosen by measured size
    newest = stage(timed.groupBy("_r", "_c").agg(F.max("_o").alias("_top"), F.max_by("q", "_o").alias("q")))
    spread = places.where("place IS NOT NULL").repartition(places.sparkSession.sparkContext.defaultParallelism, "place")
    around = place_cells(spread, km, g).where(_may_reach(km, g))
    reached = lookup_join(around, newest, ["_r", "_c"], max_copied).where("_top IS NOT NULL")
    firsts = stage(reached.withColumn("km", _km_to("q")))
    best = F.max(F.when(F.col("km") <= km, F.col("_top"))).over(Window.partitionBy("place"))
    open_cells = firsts.withColumn("_best", best).where(
        (F.col("km") > km) & (F.col("_best").isNull() | (F.col("_top") > F.col("_best")))).select(
        "place", "place_lon", "place_lat", "_r", "_c", "_best")
    tested = lookup_join(timed, open_cells, ["_r", "_c"], max_copied).where(
        F.col("place").isNotNull() & (F.col("_best").isNull() | (F.col("_o") > F.col("_best")))).withColumn("km", _km_to("q"))
    found = firsts.select("place", F.col("_top").alias("_o"), "q", "km")
    answer = found.unionByName(tested.select("place", "_o", "q", "km")).where(F.col("km") <= km)
    return answer.groupBy("place").agg(F.max_by(F.struct("q.id", "q.time_utc", "q.mag", "km"), "_o").alias("x")).select("place", "x.*")


def tsunami_near(quakes: DataFrame, places: DataFrame, km: float, since) -> DataFrame:
    """Tsunami events near the places since a time."""
    flagged = quakes.where((F.col("tsunami") == 1) & (F.col("time_utc") >= since))
    return near_places(flagged.select("id", "time_utc", "mag", "lon", "lat"), places, km).select(
        "place", "id", "time_utc", "mag", "km")


def quakes_by_country(resolved: DataFrame, countries: DataFrame, iso: str, min_mag: float, since) -> DataFrame:
    """Events of one country stronger than ``min_mag`` since a time, by date."""
    chosen = resolved.where((F.col("mag") > float(min_mag)) & (F.col("time_utc") >= since) & (F.col("country_iso") == iso))
    named = chosen.join(countries.select(F.col("iso").alias("country_iso"), F.col("name").alias("country")), "country_iso")
    return named.select("id", "time_utc", "mag", "country_iso", "country").orderBy("time_utc", "id")


HALF_ROUND_KM = 20_020.0      # farther than any two points are apart


def nearest_k_per_place(quakes: DataFrame, places: DataFrame, k: int, max_copied: int = MAX_COPIED_BYTES) -> DataFrame:
    """``(place, id, km, rank)``: the ``k`` events nearest to each place, equal distances by id.

    Circles grow until they are sure to hold enough: events are counted per grid cell, and a place stops at the first
    radius at which the cells wholly inside its circle hold ``k`` events. The k-th nearest event lies within it, so only
    then, and only for that radius, events are compared one by one. The first radius follows the mean density; a place
    far from everything goes on until the circle is the whole sphere. Poles and the antimeridian are as in ``place_cells``.
    """
    located = quakes.where("lon IS NOT NULL AND lat IS NOT NULL").select("id", "lon", "lat")
    known = stage(places.where("place IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL").select("place", "lon", "lat"))
    n = located.count()
    km = min(max(2 * math.sqrt(max(k, 1) / max(n, 1) * 4) * EARTH_RADIUS_KM, 10.0), HALF_ROUND_KM)
    found, waiting = None, known
    while True:
        chosen, whole = waiting, km >= HALF_ROUND_KM
        if not whole:
            g = next((g for g in reversed(FINE_SIZES) if g * KM_PER_DEGREE * 4 <= km), FINE_SIZES[0])
            counts = located.groupBy(cell_index(F.col("lat"), g).alias("_r"), _wrapped_column(cell_index(F.col("lon"), g), g).alias("_c")).agg(
                F.count(F.lit(1)).alias("n"))
            centre = haversine_km(F.col("place_lon"), F.col("place_lat"), (F.col("_c") + 0.5) * g, (F.col("_r") + 0.5) * g)
            inside = centre + EARTH_RADIUS_KM * math.radians(g) + 0.001 <= km
            sure = place_cells(waiting, km, g).where(inside).join(counts.hint("merge"), ["_r", "_c"]).groupBy("place").agg(F.sum("n").alias("n")).where(F.col("n") >= k)
            done = stage(sure.select("place"))
            chosen = waiting.join(done, "place", "left_semi")
        pairs = near_places(located, chosen, km, max_copied)
        order = Window.partitionBy("place").orderBy("km", "id")
        best = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("place", "id", "km", "rank")
        found = best if found is None else found.unionByName(best)
        if whole:
            return found
        waiting = stage(waiting.join(done, "place", "left_anti"))
        if waiting.isEmpty():
            return found
        km = min(km * 2, HALF_ROUND_KM)
