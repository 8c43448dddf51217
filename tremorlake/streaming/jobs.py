"""Structured Streaming over landed feed snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tremorlake.operators.features import flatten_feature
from tremorlake.operators.proximity import WatchedPlaces, last_within_km, places_near_events
from tremorlake.session import delete_path, owned_stages, stage
from tremorlake.sources.geojson import parse_features, readable_feature
from tremorlake.sources.store import load_batch

DEDUP_SALTS = 16
EVENT_BUCKETS = 1_024   # groups of events whose positions are one row of state
FEW_EVENTS = 1_000      # of a micro-batch, up to which its events are paired with places one by one
MERGE_EVERY = 50        # micro-batches whose updates lie in folders of their own before they are merged


def stream_features(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Events of landed snapshots, one feature per line; the same event may land many times."""
    return flatten_feature(parse_features(_stream_lines(spark, path, max_files), "value"))


def stream_unreadable(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed lines that hold something, but no feature: for a sink of their own."""
    return _stream_lines(spark, path, max_files).where((F.trim("value") != "") & ~readable_feature("value"))


def _stream_lines(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def _once_per_key(stream: DataFrame, keys: Sequence[str], time: str, delay: str, salts: int = DEDUP_SALTS) -> DataFrame:
    """Drop repeats of ``keys`` within the watermark.

    Repeats are dropped per salt first, so a hot key reaches the final task as at most one row per salt. The salt is
    the task that read the row, so that exact repeats of one event spread as well.
    """
    salted = stream.withWatermark(time, delay).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    first = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return first.dropDuplicatesWithinWatermark(list(keys))


def stream_dedup(stream: DataFrame, delay: str = "1 day", salts: int = DEDUP_SALTS) -> DataFrame:
    """Each event id once within the watermark. Events without an id all stay: see ``stream_without_id``."""
    return _once_per_key(stream.where("usgs_id IS NOT NULL"), ["usgs_id"], "time_utc", delay, salts)


def stream_without_id(stream: DataFrame) -> DataFrame:
    """Events without an id, which never repeat each other."""
    return stream.where("usgs_id IS NULL")


def stream_counts(stream: DataFrame, width: str = "1 hour", slide: str | None = None, delay: str = "1 day") -> DataFrame:
    """Events per tumbling or sliding window; rows later than the watermark are dropped."""
    window = F.window("time_utc", width, slide) if slide else F.window("time_utc", width)
    counted = stream.withWatermark("time_utc", delay).groupBy(window.alias("w")).agg(F.count(F.lit(1)).alias("n_events"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_events")


EARLIEST, LATEST = "1700-01-01", "2200-01-01"      # times outside count as these for the watermark; Python knows no others
POSITIONS = "usgs_id STRING, _for STRING, micros LONG, lon DOUBLE, lat DOUBLE, _lons ARRAY<DOUBLE>, _lats ARRAY<DOUBLE>"
SEEN = "ids ARRAY<STRING>, fors ARRAY<STRING>, lons ARRAY<DOUBLE>, lats ARRAY<DOUBLE>, until ARRAY<LONG>"


def _new_positions(delay_us: int) -> Callable:
    """For ``applyInPandasWithState``: positions that an event of the bucket did not report before, each with the earlier ones.

    An event without an id stands for the place in ``_for``, whatever its position. A position is remembered until the
    watermark has passed its own time by the delay, like a key of ``dropDuplicatesWithinWatermark``.
    """
    def positions(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen: dict[tuple, dict[tuple, int]] = {}
        for name, place, x, y, until in zip(*state.get, strict=True) if state.exists else ():
            seen.setdefault((name, place), {})[(x, y)] = until
        new = []
        for part in parts:
            for name, place, micros, x, y in zip(*[part[c].tolist() for c in ("usgs_id", "_for", "micros", "lon", "lat")], strict=True):
                known = seen.setdefault((name, place), {})
                if (x, y) in known or (known and name is None):
                    continue
                micros = None if pd.isna(micros) else int(micros)
                new.append((name, place, micros, x, y, [a for a, _ in known] or None, [b for _, b in known] or None))
                known[(x, y)] = (micros or 0) + delay_us
        if new:
            yield pd.DataFrame({c: pd.Series(values, dtype="Int64" if c == "micros" else "float64" if c in ("lon", "lat") else "object")
                                for c, values in zip(("usgs_id", "_for", "micros", "lon", "lat", "_lons", "_lats"), zip(*new, strict=True), strict=True)})
        passed = state.getCurrentWatermarkMs()
        held = [(*name, *at, until) for name, known in seen.items() for at, until in known.items() if until > passed * 1000]
        if not held:
            state.remove()
            return
        state.update(tuple(list(c) for c in zip(*held, strict=True)))
        state.setTimeoutTimestamp(max(1, passed, -(-min(h[-1] for h in held) // 1000) - 1))

    return positions


def tsunami_alerts(stream: DataFrame, places: DataFrame, km: float, delay: str = "1 day", salts: int = DEDUP_SALTS,
                   buckets: int = EVENT_BUCKETS) -> DataFrame:
    """Each flagged event near a watched place, once per event and place.

    The state holds the positions of events, never their places: a new position alerts the places that none of the
    event's remembered positions reaches. Only events without an id, which all count as one, are remembered per place.
    Repeats of a position are dropped per salt first, as in ``_once_per_key``.
    """
    watched = WatchedPlaces(places, km)
    # the salt also keeps what follows from being asked of the text again: a filter is not moved below a task's number
    flagged = stream.where("tsunami = 1 AND lon IS NOT NULL AND lat IS NOT NULL").select(
        "usgs_id", "time_utc", "lon", "lat", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"))
    at = F.greatest(F.least("time_utc", F.lit(LATEST).cast("timestamp")), F.lit(EARLIEST).cast("timestamp"))
    near = watched.events_in_reach(flagged, F.col("usgs_id").isNull()).withColumn("_at", F.when(F.col("time_utc").isNotNull(), at))
    timed = near.withColumn("micros", F.unix_micros(F.col("time_utc").cast("timestamp"))).withWatermark("_at", delay).withColumns({
        "_x": F.when(F.col("_for").isNull(), F.col("lon")),
        "_y": F.when(F.col("_for").isNull(), F.col("lat")), "_bucket": F.pmod(F.xxhash64("usgs_id", "_for"), F.lit(buckets))})
    first = timed.dropDuplicatesWithinWatermark(["usgs_id", "_for", "_x", "_y", "_salt"]).select(
        "_bucket", "usgs_id", "_for", "micros", "lon", "lat", "_at")
    delay_us = stream.sparkSession.sql(f"SELECT unix_micros(TIMESTAMP'1970-01-01 00:00:00 UTC' + INTERVAL {delay})").first()[0]
    moved = first.groupBy("_bucket").applyInPandasWithState(
        _new_positions(delay_us), POSITIONS, SEEN, "append", GroupStateTimeout.EventTimeTimeout)
    timed_again = F.timestamp_micros("micros").cast(stream.schema["time_utc"].dataType).alias("time_utc")
    return watched.alerts(moved.select("usgs_id", timed_again, "lon", "lat", "_for", "_lons", "_lats")).select(
        "usgs_id", "time_utc", "lon", "lat", "place", "km")


def last_quakes(events: DataFrame, places: DataFrame, km: float, few: int = FEW_EVENTS) -> DataFrame:
    """The newest of ``events`` per watched place that has one, for one micro-batch.

    A few events are paired with the places in their own circles, where every place stands once, so a small batch spreads
    no place over cells. Of many, every grid cell answers with its newest, so neither pairs nor sorts grow with both sides.
    """
    timed = events.where("time_utc IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL").select("usgs_id", "time_utc", "mag", "lon", "lat")
    if timed.limit(few + 1).count() > few:
        newest = last_within_km(timed.withColumnRenamed("usgs_id", "id"), places.where("lon IS NOT NULL AND lat IS NOT NULL"), km)
        return newest.withColumnRenamed("id", "usgs_id")
    return latest_quake(places_near_events(timed, places, km))


def start_last_quake(stream: DataFrame, places: DataFrame, km: float, path: str, checkpoint: str,
                     merge_every: int = MERGE_EVERY, few: int = FEW_EVENTS) -> StreamingQuery:
    """Write the newest event per place of each micro-batch to a folder of its own; ``latest_quake`` reads them.

    No state is kept: the folders are merged from time to time by the time of the events, so a late event never
    replaces a newer one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        with owned_stages(batch.sparkSession):
            landed = stage(batch.select("usgs_id", "time_utc", "mag", "lon", "lat"))
            _write_update(last_quakes(landed, places, km, few), path, batch_id, latest_quake, merge_every)

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_quake(updates: DataFrame) -> DataFrame:
    """The newest event per place over all that ``start_last_quake`` wrote; a late event never replaces a newer one."""
    newest = F.max_by(F.struct("usgs_id", "time_utc", "mag", "km"), F.struct("time_utc", "usgs_id"))
    return updates.groupBy("place").agg(newest.alias("q")).select("place", "q.*")


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Fix the number of state partitions of the streams started inside, by default one per core.

    A stream keeps the number of its first start for life, and it is not merged at run time like that of
    a batch job; a stream takes its own copy of the settings when it starts.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write finished rows to Parquet files."""
    return (stream.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_updates(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] | None = None,
                  merge_every: int = MERGE_EVERY) -> StreamingQuery:
    """Write changed rows of each micro-batch to a folder of its own, replaced if the batch is retried.

    With the ``keys`` of the rows the folders are merged from time to time, so that their number stays bounded and
    ``latest_updates`` reads about one version of each row.
    """
    merge = (lambda updates: latest_updates(updates, keys)) if keys else None

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_update(batch, path, batch_id, merge, merge_every)

    return (stream.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _write_update(rows: DataFrame, path: str, batch_id: int, merge: Callable[[DataFrame], DataFrame] | None,
                  every: int = MERGE_EVERY) -> None:
    """Batch ``n`` goes to folder ``2n``; every so many batches all folders up to there are merged into ``2n + 1``.

    A merged folder holds what the folders before it say, so readers may see them together. They are deleted one
    merge later, when those who listed them have finished. A retried batch writes the same folders again.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/batch={2 * batch_id}")
    if merge is None or (batch_id + 1) % every:
        return
    merged, before = 2 * batch_id + 1, 2 * (batch_id - every) + 1
    written = spark.read.parquet(path).where(F.col("batch") < merged)
    merge(written).write.mode("overwrite").parquet(f"{path}/batch={merged}")
    for old in written.where(F.col("batch") < before).select("batch").distinct().collect():     # a few folder numbers
        delete_path(spark, f"{path}/batch={old['batch']}")


def latest_updates(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each row that ``start_updates`` wrote."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*rest), "batch")
    return updates.groupBy(*keys).agg(newest.alias("_v")).select(*keys, "_v.*")


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint; written before its first batch."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def start_insert_new(stream: DataFrame, store: str, checkpoint: str, arrival: Sequence[Column | str] = ("updated_utc",)) -> StreamingQuery:
    """Insert new events batch by batch. A retried batch replaces its own rows and nothing else.

    Loads carry the stream's own id, so any number of streams may fill one store, one after another. A stream that
    lost its checkpoint is a new one: what it replays is found in the store, by id, or without one by its content.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        series = f"stream-{_query_id(batch.sparkSession, checkpoint)}-"
        load_batch(batch.sparkSession, store, batch, list(arrival), load_id=f"{series}{batch_id}", replayed_from=series)

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
