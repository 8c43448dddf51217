"""The event store: Parquet by event month, appended once per event, with a log of loads.

One writer at a time: plain Parquet has no transactions.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tremorlake.operators.membership import key_filters, possible_folders
from tremorlake.operators.tables import dense_ids, insert_new, upsert_location
from tremorlake.schema import LOAD_LOG, LOCATION, QUAKE
from tremorlake.session import delete_path, owned_stages, stage

LOAD, MONTH = "load_id", "event_month"
FOLDER = [LOAD, MONTH]
MEMBERS = "_members"            # beside the folders of the store; readers skip names that begin with an underscore
LOCATION_BLOCK = 1_000_000      # ids per partition of the location table


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def _folder_name(spark: SparkSession, column: str, value: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def event_key() -> Column:
    """What an event is known by: its ``usgs_id``, or without one all it says."""
    said = [F.coalesce(F.col(f.name).cast("string"), F.lit("\x00")) for f in QUAKE.fields if f.name not in ("id", "usgs_id")]
    return F.coalesce("usgs_id", F.concat(F.lit("\x00"), F.md5(F.concat_ws("\x1f", *said))))


def _members(spark: SparkSession, path: str) -> DataFrame | None:
    """The key filters of the store's folders, each with the folder's largest id."""
    parts = [f"{path}/{MEMBERS}/{n}" for n in _children(spark, f"{path}/{MEMBERS}")]
    return spark.read.schema(f"{LOAD} STRING, {MONTH} STRING, top LONG, blocks LONG, block LONG, bits BINARY").parquet(*parts) if parts else None


def _read_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """The events of some folders; the others are neither listed nor read."""
    if not folders:
        return scan_quake(spark, path).where("false")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUAKE.fields)
    return spark.read.option("basePath", path).schema(f"{fields}, {LOAD} STRING, {MONTH} STRING").parquet(*[f"{path}/{f}" for f in folders])


def folders_to_open(spark: SparkSession, path: str, keys: DataFrame, key: str) -> tuple[list[str], int]:
    """(folders that may hold one of ``keys``, largest id stored). Only names and key filters are read for it.

    Folders of a store older than its filters have none and are always opened.
    """
    loads = [n for n in _children(spark, path) if n.startswith(f"{LOAD}=")]
    there = {f"{load}/{month}" for load in loads for month in _children(spark, f"{path}/{load}") if month.startswith(f"{MONTH}=")}
    members = _members(spark, path)
    name = lambda r: f"{_folder_name(spark, LOAD, r[LOAD])}/{_folder_name(spark, MONTH, r[MONTH])}"
    if members is None:
        held, chosen = {}, set()
    else:
        # a row per folder of the store
        held = {name(r): r["top"] for r in members.groupBy(*FOLDER).agg(F.max("top").alias("top")).collect()}
        chosen = {name(r) for r in possible_folders(members, keys, key, FOLDER).collect()}
    bare = sorted(there - held.keys())
    top = max([-1, *(held[f] for f in there & held.keys())])
    if bare:
        top = max(top, _read_folders(spark, path, bare).agg(F.coalesce(F.max("id"), F.lit(-1))).first()[0])
    return sorted(chosen & there) + bare, top


def scan_quake(spark: SparkSession, path: str) -> DataFrame:
    """The stored events; an absent store is empty. Filters on ``event_month`` read only those months."""
    if not _exists(spark, path):
        return spark.createDataFrame([], QUAKE).withColumns(
            {LOAD: F.lit(None).cast("string"), MONTH: F.lit(None).cast("string")})
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUAKE.fields)
    return spark.read.schema(f"{fields}, {LOAD} STRING, {MONTH} STRING").parquet(path)


def load_batch(spark: SparkSession, path: str, batch: DataFrame, arrival: list, load_id: str, replayed_from: str | None = None) -> tuple[int, int]:
    """Store the events of ``batch`` that are not stored yet; returns (submitted, inserted).

    The batch is landed first, so that its source, which may be a service, is read once. A load owns the
    partitions of its ``load_id``: repeating it replaces all of its rows, in whatever months they lay, and an event
    it stored before keeps its id (events without a ``usgs_id`` cannot be told apart and are numbered anew). So a
    retry after a lost driver leaves the same store. Of the stored side only folders are opened whose key filter may
    hold an id of the batch. Rows are sorted by time inside each file so that row groups skip on time.

    ``replayed_from`` names the series of loads (the beginning of their ids) that this one continues. An event without
    an id whose equal in all columns a load outside of the series stored is then taken for a replay of it and left out.
    """
    with owned_stages(spark):
        missing = [f for f in QUAKE.fields if f.name != "id" and f.name not in batch.columns]
        raw = stage(batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).withColumn("_key", event_key()))
        asked = raw if replayed_from else raw.where("usgs_id IS NOT NULL")
        folders, top = folders_to_open(spark, path, asked, "_key")
        mine = f"{_folder_name(spark, LOAD, load_id)}/"
        others = _read_folders(spark, path, [f for f in folders if not f.startswith(mine)])
        own = _read_folders(spark, path, [f for f in folders if f.startswith(mine)]).where("usgs_id IS NOT NULL")
        offered = raw
        if replayed_from:
            strange = others.where("usgs_id IS NULL").where(~F.col(LOAD).startswith(replayed_from)).select(event_key().alias("_key")).distinct()
            offered = raw.where("usgs_id IS NOT NULL").unionByName(raw.where("usgs_id IS NULL").join(strange, "_key", "left_anti").select(*raw.columns))
        new = stage(insert_new(others.select("usgs_id"), offered, arrival).select(*[
            F.col(f.name).cast(f.dataType) for f in QUAKE.fields if f.name != "id"]))
        known = stage(own.select("usgs_id", "id"))
        again = new.join(known, "usgs_id")
        fresh = dense_ids(new.join(known.select("usgs_id"), "usgs_id", "left_anti").select(*new.columns), top)
        numbered = stage(again.select(*fresh.columns).unionByName(fresh).withColumns({
            LOAD: F.lit(load_id), MONTH: F.coalesce(F.date_format("time_utc", "yyyy-MM"), F.lit("unknown"))}))
        months = numbered.repartitionByRange(MONTH, "time_utc", "id").sortWithinPartitions(MONTH, "time_utc")
        inserted = Observation("inserted")
        _replace_load(spark, path, load_id, months.observe(inserted, F.count(F.lit(1)).alias("n")), _filters_of(numbered))
        return raw.count(), inserted.get["n"]


def _filters_of(rows: DataFrame) -> DataFrame:
    tops = rows.groupBy(*FOLDER).agg(F.max("id").alias("top"))
    return key_filters(rows, event_key(), FOLDER).join(tops, FOLDER).select(*FOLDER, "top", "blocks", "block", "bits")


def _replace_load(spark: SparkSession, path: str, load_id: str, rows: DataFrame, filters: DataFrame) -> None:
    """Write all rows of a load beside the store, then let them take the place of what the load stored before.

    Readers skip folders whose name begins with an underscore. The new key filters are there before the rows are, the
    old ones go after the old rows went, so no row is ever without its filter. A job lost in between is repeated with
    the same ``load_id``.
    """
    fresh = f"{path}/_load-{uuid.uuid4().hex}"
    rows.write.partitionBy(LOAD, MONTH).parquet(fresh)
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    there = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    own = _folder_name(spark, LOAD, load_id)
    before = [n for n in _children(spark, f"{path}/{MEMBERS}") if n.rpartition(".")[0] == own]
    filters.write.parquet(f"{path}/{MEMBERS}/{own}.{uuid.uuid4().hex}")
    if files.exists(there(f"{path}/{own}")):
        files.delete(there(f"{path}/{own}"), True)
    if files.exists(there(f"{fresh}/{own}")):
        files.rename(there(f"{fresh}/{own}"), there(f"{path}/{own}"))
    for name in before:
        files.delete(there(f"{path}/{MEMBERS}/{name}"), True)
    files.delete(there(fresh), True)


def append_load_log(spark: SparkSession, path: str, source: str, start: datetime, end: datetime,
                    submitted: int, inserted: int, status: str, created_at: datetime, load_id: str | None = None) -> None:
    """One row per load, with what was really inserted and the real status; a repeated ``load_id`` replaces its row."""
    row = (source, start, end, submitted, inserted, status, created_at)
    write_load_log(spark.createDataFrame([row], LOAD_LOG), path, load_id or uuid.uuid4().hex)


def write_load_log(rows: DataFrame, path: str, load_id: str) -> None:
    """All log rows of one load; repeating the load replaces them."""
    rows.select(*LOAD_LOG.fieldNames(), F.lit(load_id).alias(LOAD)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(path)


def read_load_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOAD_LOG).parquet(path) if _exists(spark, path) else spark.createDataFrame([], LOAD_LOG)


def read_location(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        return spark.createDataFrame([], LOCATION)
    return spark.read.parquet(path).select(*LOCATION.fieldNames())


def write_location(spark: SparkSession, path: str, new: DataFrame) -> None:
    """Upsert location rows, rewriting only the id blocks that ``new`` touches."""
    block = F.floor(F.col("quake_id") / LOCATION_BLOCK).cast("long").alias("id_block")
    with owned_stages(spark):
        fresh = stage(new.select(*LOCATION.fieldNames()))
        merged = fresh
        if _exists(spark, path):
            touched = fresh.select(block).distinct()
            stored = spark.read.parquet(path).join(touched, "id_block", "left_semi")
            merged = stage(upsert_location(stored, fresh))   # the files read here are replaced below
        merged.select("*", block).repartition("id_block", F.pmod(F.xxhash64("quake_id"), F.lit(8))).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("id_block").parquet(path)
