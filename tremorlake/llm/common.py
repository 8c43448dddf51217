"""Helpers shared by the text operators: reading, staging, words, hot keys and connected components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.session import checkpoint_dir

#: Rows of one Arrow batch in tasks that hold whole texts; texts of any length pass, so batches stay short.
TEXT_BATCH_ROWS = 256
#: The word separators of every contract: space and the five control characters x09 to x0D.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def use_text_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Whole texts travel in short Arrow batches, which bounds the memory of a Python worker.

    Also lets the Python workers find this package where it lies, whatever folder the session was started from. On a
    cluster it is installed on all machines or sent with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    workers = spark.sparkContext.environment
    paths = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
    if os.path.isdir(root) and root not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


class Scratch:
    """Owner of the intermediate tables of one operator run, in the shared folder of the session.

    Tables that the returned DataFrame still reads are kept (``keep=True``); ``close`` deletes the others.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.temporary: list[str] = []

    def stage(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        if not keep:
            self.temporary.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df_path: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        for path in self.temporary:
            self.drop(path)
        self.temporary.clear()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def map_texts(
    df: DataFrame, columns: list[str], fields: list[tuple[str, T.DataType]], make: Callable[[], Callable[[dict], dict]],
) -> DataFrame:
    """Apply a batch function in tasks and return exactly ``fields``.

    ``make`` builds, once per task, a function from a dict of Python lists (one per column) to a dict of lists.
    """
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields])
    names = [name for name, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        work = make()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = work({c: batch.column(i).to_pylist() for i, c in enumerate(columns)})
            yield pa.RecordBatch.from_arrays([pa.array(out[n], type=arrow.field(n).type) for n in names], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased: exactly what ``bytes`` lower-cases and splits on."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values (multiply and xor-shift, wrapping)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit value for each run of ``n`` words; order matters."""
    count = len(hashes) - n + 1
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + count]
    return mix(total)


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Distinct 64-bit values of the ``n``-word shingles, sorted; fewer words make one shingle, none make none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = hash_words(words)
    return np.unique(windows(hashes, min(n, len(words))))


def components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id): the smallest id reachable over undirected ``edges``; ids without an edge are absent.

    Alternates two star steps until nothing changes: every node points its larger neighbours to its smallest
    neighbour, then itself and its smaller neighbours. Each step is one aggregation over the edges, ids move
    only in the shuffle, and the number of steps grows with the logarithm of the longest path. A node with very
    many neighbours never has them gathered: only minima are aggregated and joined back.
    """
    current = scratch.stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        following = scratch.stage(small, "edges")
        # A fixed point has every node on exactly one edge, to a node that is no one's larger end.
        heads = following.select(F.col("v").alias("u")).distinct().join(following, "u", "left_semi")
        many = following.groupBy("u").count().where("count > 1")
        if heads.isEmpty() and many.isEmpty():
            break
        current = following
    tails = following.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = following.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return tails.unionByName(roots)


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str, max_rows: int) -> DataFrame:
    """Copy ``right`` to the executors only when it was counted and is short; otherwise join by shuffle."""
    rows = right.groupBy().count().first()[0]
    return left.join(F.broadcast(right) if rows <= max_rows else right, on, how)
