"""Parallel fetch of an event service, one task call per time window.

``fetch(start, end)`` is given by the caller and returns the feature texts of a window, at most as many
as the service allows in one answer. A window that fails becomes a status row instead of no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tremorlake.sources.geojson import parse_features, readable_feature

Fetch = Callable[[datetime, datetime], Iterable[str]]

FETCHED = "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, status STRING, message STRING, feature STRING"
MAX_LISTED_WINDOWS = 10_000
BLOCK_ROWS = 5_000                # rows a task hands on at once


class TooManyEvents(Exception):
    """What ``fetch`` raises when the service refuses a window as too large."""


def _caller(fetch: Fetch) -> Callable[[datetime, datetime], Iterator[tuple]]:
    """A nested function travels to the tasks by value, so executors need nothing installed but Spark."""
    refusal = TooManyEvents.__name__

    def call(start: datetime, end: datetime) -> Iterator[tuple]:
        """The features of a window and a status row for every part that was asked for in the end.

        A refused window is halved at a whole second, half-open, the earlier half first. A refused window of one
        second has the status ``over_cap``, any other failure ``error``, both without features.
        """
        waiting = [(start, end)]
        while waiting:
            low, high = waiting.pop()
            held = 0
            try:
                for feature in fetch(low, high):
                    held += 1
                    yield low, high, "feature", None, feature
                yield low, high, "success", None, None
            except Exception as error:  # any failure of the service or the network belongs in the log
                refused = any(kind.__name__ == refusal for kind in type(error).__mro__)
                seconds = int((high - low).total_seconds())
                if refused and not held and seconds > 1:
                    middle = low + timedelta(seconds=seconds // 2)
                    waiting += [(middle, high), (low, middle)]
                else:
                    yield low, high, "over_cap" if refused and not held else "partial" if held else "error", str(error), None

    return call


def fetch_windows(windows: DataFrame, fetch: Fetch, tasks: int | None = None) -> DataFrame:
    """Fetch ``(window_start, window_end)`` rows where they are; any number of windows.

    A window that the service refuses is split where it is fetched, so no count has to be known before. Rows are
    handed on in blocks, so an answer of any size passes.
    """
    call, block_rows = _caller(fetch), BLOCK_ROWS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, end in zip(batch["window_start"], batch["window_end"]):
                rows = call(start.to_pydatetime(), end.to_pydatetime())
                while block := list(islice(rows, block_rows)):
                    yield pd.DataFrame(block, columns=["window_start", "window_end", "status", "message", "feature"])

    spread = windows.select("window_start", "window_end")
    spread = spread.repartition(tasks or int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInPandas(run, FETCHED)


def feed_source(source_name: str, fetch_events: Fetch) -> type[DataSource]:
    """A source for ``spark.dataSource.register``: one partition per window.

    Options: ``windows``, a JSON list of ``[start, end]`` ISO texts, or ``start``, ``end`` and ``seconds``
    for equal windows. The list is plan metadata, so it is limited; use ``fetch_windows`` beyond it.
    """
    call, limit, fetched = _caller(fetch_events), MAX_LISTED_WINDOWS, FETCHED

    class WindowPartition(InputPartition):
        def __init__(self, start: datetime, end: datetime):
            self.start, self.end = start, end

    class FeedReader(DataSourceReader):
        def __init__(self, windows: list[tuple[datetime, datetime]]):
            self.windows = windows

        def partitions(self) -> list[InputPartition]:
            return [WindowPartition(a, b) for a, b in self.windows]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            yield from call(partition.start, partition.end)

    class FeedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return source_name

        def schema(self) -> str:
            return fetched

        def reader(self, schema) -> DataSourceReader:
            listed = self.options.get("windows")
            if listed:
                windows = [tuple(map(datetime.fromisoformat, w)) for w in json.loads(listed)]
            else:
                start, end = (datetime.fromisoformat(self.options[k]) for k in ("start", "end"))
                width = timedelta(seconds=int(self.options["seconds"]))
                windows = range(-(-(end - start) // width))
                if len(windows) <= limit:
                    windows = [(start + i * width, min(start + (i + 1) * width, end)) for i in windows]
            if len(windows) > limit:
                raise ValueError("too many windows for one plan, use fetch_windows")
            return FeedReader(windows)

    return FeedSource


def fetched_features(fetched: DataFrame) -> DataFrame:
    """Feature rows ``(id, geometry, properties)`` of a fetch."""
    return parse_features(fetched.where("status = 'feature'"), "feature")


def fetch_log(fetched: DataFrame, source: str) -> DataFrame:
    """One load-log row per window asked for in the end: how many rows came, and how it ended.

    A window with texts that are no features is ``partial``, whatever the service said.
    """
    broken = (F.col("status") == "feature") & ~readable_feature("feature")
    per_window = fetched.groupBy("window_start", "window_end").agg(
        F.count_if((F.col("status") == "feature") & ~broken).alias("rows_submitted"), F.bool_or(broken).alias("broken"),
        F.max(F.when(F.col("status") != "feature", F.col("status"))).alias("status")).withColumn(
        "status", F.when(F.col("broken") & (F.col("status") == "success"), F.lit("partial")).otherwise(F.col("status")))
    return per_window.select(
        F.lit(source).alias("source"), F.col("window_start").alias("start_time_utc"),
        F.col("window_end").alias("end_time_utc"), "rows_submitted", "status")


def union_fetches(parts: list[DataFrame]) -> DataFrame:
    """Features of several fetches one after another; repeats stay."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
