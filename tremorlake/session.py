"""Session settings and the shared folders a job may write to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package relies on; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName("tremorlake")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC; casts between TIMESTAMP and TIMESTAMP_NTZ follow the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) gets a temporary folder of its own; on a cluster a
    machine-local folder would be lost with the machine, so the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tremorlake-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Fix the rows of a small ``df`` in the shared folder, so later jobs neither recompute nor reorder them."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_owners = threading.local()     # a stream runs its batches in a thread of its own


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def owned_stages(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables that ``stage`` wrote inside. For jobs that end with their own write."""
    outer, _owners.paths = getattr(_owners, "paths", None), []
    try:
        yield
    finally:
        for path in _owners.paths:
            delete_path(spark, path)
        _owners.paths = outer


def stage(df: DataFrame) -> DataFrame:
    """As ``pin`` for large data: a Parquet table in the shared folder, which later jobs read by column.

    Inside ``owned_stages`` the table goes with its owner; outside, the caller still reads it and it stays.
    """
    path = scratch_path(df.sparkSession, "stage")
    if getattr(_owners, "paths", None) is not None:
        _owners.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
