"""The live feed as a streaming source: time offsets, one partition per window of event time, the caller's fetch.

The offset is the second up to which the service was asked. A micro-batch covers the time from the last offset to the
newest whole window that is ``delay`` seconds old; its windows are fetched in parallel, and a window the service refuses
is halved inside its task. The engine keeps the offsets in the stream's checkpoint and writes them before a batch runs,
so a stream that was stopped goes on with the same windows: none is left out and none is asked for in two batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tremorlake.operators.features import flatten_feature
from tremorlake.sources.feed import FETCHED, MAX_LISTED_WINDOWS, Fetch, _caller, fetched_features

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def live_source(source_name: str, fetch: Fetch, clock: Clock = utc_now, on_committed: Callable[[datetime], None] | None = None) -> type[DataSource]:
    """A streaming source for ``spark.dataSource.register``; all times are UTC.

    Options: ``start`` (ISO text, first second asked for), ``seconds`` (width of a window, default 60), ``delay`` (how old
    a window must be before it is asked for, default 0: events reported later than that are not seen) and ``failures``:
    ``stop`` (default) fails the batch when a window fails, so that a restart asks again, ``log`` hands the status row on.
    After a long pause windows are wider, so that a batch has at most ``MAX_LISTED_WINDOWS`` of them.
    """
    call, most, fetched = _caller(fetch), MAX_LISTED_WINDOWS, FETCHED
    epoch = datetime(1970, 1, 1)

    class LiveWindow(InputPartition):
        def __init__(self, start: int, end: int):
            self.start, self.end = start, end

    class LiveReader(DataSourceStreamReader):
        def __init__(self, options):
            self.first = int((datetime.fromisoformat(options["start"]) - epoch).total_seconds())
            self.width = int(options.get("seconds", 60))
            self.delay = int(options.get("delay", 0))
            self.failures = options.get("failures", "stop")
            if self.width < 1 or self.failures not in ("stop", "log"):
                raise ValueError("seconds must be positive, failures stop or log")

        def initialOffset(self) -> dict:
            return {"second": self.first}

        def latestOffset(self) -> dict:
            now = int((clock() - epoch).total_seconds()) - self.delay
            return {"second": self.first + max(0, now - self.first) // self.width * self.width}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            low, high = start["second"], end["second"]
            if high <= low:             # a clock that went back
                return []
            step = self.width * -(-(high - low) // (self.width * most))
            return [LiveWindow(a, min(a + step, high)) for a in range(low, high, step)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            for row in call(epoch + timedelta(seconds=partition.start), epoch + timedelta(seconds=partition.end)):
                if self.failures == "stop" and row[2] not in ("feature", "success"):
                    raise RuntimeError(f"window {row[0]} to {row[1]}: {row[2]}: {row[3]}")
                yield row

        def commit(self, end: dict) -> None:
            if on_committed:
                on_committed(epoch + timedelta(seconds=end["second"]))

    class LiveFeed(DataSource):
        @classmethod
        def name(cls) -> str:
            return source_name

        def schema(self) -> str:
            return fetched

        def streamReader(self, schema) -> DataSourceStreamReader:
            return LiveReader(self.options)

    return LiveFeed


def stream_live(spark: SparkSession, source_name: str, start: datetime, **options: str | int) -> DataFrame:
    """Events of a registered live source, as ``stream_features`` gives those of landed snapshots."""
    reader = spark.readStream.format(source_name).option("start", start.isoformat())
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return flatten_feature(fetched_features(reader.load()))
