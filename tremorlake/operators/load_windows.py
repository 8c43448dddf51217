"""Time windows for loading: months, last days, halving to a size, and gaps between loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorlake.session import pin, stage

CHUNK_SECONDS = 86_400
LEVELS_PER_ROUND = 8


def month_windows(ends: DataFrame, end: str = "end_ts") -> DataFrame:
    """The 365 days before the month of ``end``, cut at months: half-open ``[window_start, window_end)``."""
    bounds = ends.select(F.date_trunc("month", F.col(end)).cast("timestamp_ntz").alias("stop")).select(
        "stop", (F.col("stop") - F.expr("INTERVAL '365' DAY")).alias("start"))
    months = bounds.select("stop", "start", F.explode(F.sequence(
        F.date_trunc("month", "start").cast("timestamp_ntz"), F.col("stop") - F.expr("INTERVAL '1' SECOND"),
        F.expr("INTERVAL '1' MONTH"))).alias("month"))
    return months.select(
        F.greatest("month", "start").alias("window_start"),
        (F.col("month") + F.expr("INTERVAL '1' MONTH")).alias("window_end"))


def last_days_window(now: Column, days: int = 30) -> tuple[Column, Column]:
    """Start and end of the last ``days`` days, ``now`` cut to the second."""
    end = F.date_trunc("second", now).cast("timestamp_ntz")
    return end - F.expr(f"INTERVAL '{days}' DAY"), end


def _walk_down(rows: DataFrame, levels: int) -> DataFrame:
    """The windows each second passes from its window ``(a, b)`` down ``levels`` halvings, as ``path``."""
    def halve(path: Column, _: Column) -> Column:
        last = F.element_at(path, -1)
        mid = F.shiftright(last["a"] + last["b"], 1)
        half = F.when(F.col("s") < mid, F.struct(last["a"].alias("a"), mid.alias("b"))).otherwise(
            F.struct(mid.alias("a"), last["b"].alias("b")))
        return F.when(last["b"] - last["a"] > 1, F.concat(path, F.array(half))).otherwise(path)

    return rows.select("s", "n", F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.array(F.struct("a", "b")), halve).alias("path"))


def plan_fetch_windows(seconds: DataFrame, start_s: int, end_s: int, cap: int) -> DataFrame:
    """Halve ``[start_s, end_s)`` until each window holds at most ``cap`` events or is one second wide.

    ``seconds`` has the epoch second ``s`` of each event; events are counted per second first, so a hot
    second is one row. A round lists the windows on the way of each second over several halvings and
    counts them in one aggregation; only the seconds of windows still over the cap enter the next round,
    so a year takes at most four. Returns half-open ``(start_s, end_s, n_events, over_cap)``.
    """
    if end_s <= start_s:
        raise ValueError("start must be before end")
    spark = seconds.sparkSession
    counted = seconds.where((F.col("s") >= start_s) & (F.col("s") < end_s)).groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    whole = {"a": F.lit(start_s).cast("long"), "b": F.lit(end_s).cast("long")}
    rows, roots = stage(counted).withColumns(whole), spark.range(1).select(*[c.alias(k) for k, c in whole.items()])
    over = (F.col("n") > cap) & (F.col("b") - F.col("a") > 1)
    mid = F.shiftright(F.col("a") + F.col("b"), 1)
    halves = F.array(F.struct(F.col("a").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b").alias("b")))
    finished = []
    while True:
        walked = _walk_down(rows, LEVELS_PER_ROUND)
        passed = walked.select("n", F.posexplode("path").alias("level", "w")).select(
            "n", "w.*", ((F.col("level") == LEVELS_PER_ROUND) & (F.col("w.b") - F.col("w.a") > 1)).alias("unfinished"))
        nodes = pin(passed.groupBy("a", "b", "unfinished").agg(F.sum("n").alias("n")))
        children = nodes.where(over & ~F.col("unfinished")).select(F.inline(halves))
        reached = children.unionAll(roots).join(nodes, ["a", "b"], "left").select(
            "a", "b", F.coalesce("n", F.lit(0)).alias("n"))
        finished.append(reached.where(~over))
        roots = nodes.where(over & F.col("unfinished")).select("a", "b")
        if roots.isEmpty():
            break
        rows = walked.select("s", "n", F.element_at("path", -1).alias("w")).select("s", "n", "w.*").join(roots, ["a", "b"], "left_semi")
    windows = finished[0]
    for more in finished[1:]:
        windows = windows.unionAll(more)
    return windows.select(
        F.col("a").alias("start_s"), F.col("b").alias("end_s"), F.col("n").cast("long").alias("n_events"),
        (F.col("n") > cap).alias("over_cap"))


def coverage_gaps(load_log: DataFrame) -> DataFrame:
    """Intervals between successful loads of a source that no load covers.

    Loads of the same source and second are merged before the shuffle, and running maxima are taken per
    day and then over days: a window never holds more than the seconds of one day or the days of the log.
    """
    done = load_log.where("status = 'success'").select(
        "source", F.date_trunc("second", "start_time_utc").cast("timestamp_ntz").alias("a"),
        F.col("end_time_utc").cast("timestamp_ntz").alias("b"))
    loads = stage(done.groupBy("source", "a").agg(F.max("b").alias("b")))   # read twice below
    day = F.floor(F.unix_seconds(F.col("a").cast("timestamp")) / CHUNK_SECONDS).alias("day")
    daily = loads.select("source", "a", "b", day)
    earlier = Window.partitionBy("source").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    before_day = daily.groupBy("source", "day").agg(F.max("b").alias("b")).select(
        "source", "day", F.max("b").over(earlier).alias("before_day"))
    inside = Window.partitionBy("source", "day").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    covered = daily.withColumn("before_load", F.max("b").over(inside)).join(before_day, ["source", "day"]).select(
        "source", "a", F.greatest("before_load", "before_day").alias("upto"))
    return covered.where("a > upto").select("source", F.col("upto").alias("gap_start"), F.col("a").alias("gap_end"))


def backfill_windows(load_log: DataFrame, wanted: DataFrame, max_seconds: int) -> DataFrame:
    """``(source, window_start, window_end)`` still to fetch: wanted intervals minus what successful loads cover.

    ``wanted`` has ``(source, wanted_start, wanted_end)``, widened to whole seconds; what failed or came in part counts as
    missing and comes again, before the first load and after the last one as well. Pieces longer than ``max_seconds`` are
    cut into windows of that length. Wanted intervals of a source are answered each for itself.
    """
    whole = F.date_trunc("second", "wanted_end").cast("timestamp_ntz")
    ask = wanted.select("source", F.date_trunc("second", "wanted_start").cast("timestamp_ntz").alias("w0"), F.when(
        whole < F.col("wanted_end").cast("timestamp_ntz"), whole + F.expr("INTERVAL '1' SECOND")).otherwise(whole).alias("w1")).where("w0 < w1").distinct()
    key = F.struct("source", "w0", "w1").alias("source")
    start, end = F.col("start_time_utc").cast("timestamp_ntz"), F.col("end_time_utc").cast("timestamp_ntz")
    inside = load_log.where("status = 'success'").join(ask, "source").where((end > F.col("w0")) & (start < F.col("w1"))).select(
        key, F.greatest(start, "w0").alias("start_time_utc"), F.least(end, "w1").alias("end_time_utc"), "status")
    # an empty load at both bounds makes what is missing before the first and after the last load a gap like any other
    bounds = ask.select(key, F.explode(F.array("w0", "w1")).alias("start_time_utc")).select(
        "source", "start_time_utc", F.col("start_time_utc").alias("end_time_utc"), F.lit("success").alias("status"))
    gaps = coverage_gaps(inside.unionByName(bounds))
    seconds = F.unix_seconds(F.col("gap_end").cast("timestamp")) - F.unix_seconds(F.col("gap_start").cast("timestamp"))
    pieces = gaps.select(F.col("source.source").alias("source"), "gap_start", "gap_end", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((seconds - 1) / max_seconds).cast("long"))).alias("k"))
    after = lambda k: F.timestamp_add("SECOND", (k * max_seconds).cast("int"), F.col("gap_start"))
    return pieces.select("source", after(F.col("k")).alias("window_start"), F.least(after(F.col("k") + 1), "gap_end").alias("window_end"))


def latest_coverage(load_log: DataFrame) -> DataFrame:
    """How far each source is loaded."""
    return load_log.where("status = 'success'").groupBy("source").agg(F.max("end_time_utc").alias("covered_to"))


def load_log_rows(submitted: DataFrame, inserted: DataFrame, source: str) -> DataFrame:
    """A log row per source and day: rows that came and rows that were stored.

    Both sides are counted before they meet, so the join is over days, not over events.
    """
    def per_day(df: DataFrame, name: str) -> DataFrame:
        day = F.date_trunc("day", "time_utc").cast("timestamp_ntz")
        return df.where("time_utc IS NOT NULL").groupBy(F.col(source).alias("source"), day.alias("start_time_utc")).agg(
            F.count(F.lit(1)).alias(name))

    both = per_day(submitted, "rows_submitted").join(per_day(inserted, "rows_inserted"), ["source", "start_time_utc"], "left")
    return both.select(
        "source", "start_time_utc", (F.col("start_time_utc") + F.expr("INTERVAL '1' DAY")).alias("end_time_utc"),
        "rows_submitted", F.coalesce("rows_inserted", F.lit(0)).alias("rows_inserted"), F.lit("success").alias("status"))
