"""Target-distribution importance resampling: hashed n-gram weights and a distributed radix sort for the draw.

Runs of one to three words fall into hashed buckets. The share of a bucket in a target table over its share in the
whole corpus gives the bucket's gain; a document's weight is the sum of the gains of its features, read from an array.
Adding Gumbel noise that depends on the id alone and taking the highest sums draws documents without replacement with
probabilities that follow the weights.

The order comes from a least-significant-digit radix sort over the composite key (score descending, id ascending).
Every pass is a stable counting sort: rows stand in blocks of consecutive places; rows are counted per digit and
block; offsets added up over digits, and within a digit over blocks, say where each block's rows of a digit begin; a
row's destination is that offset plus its number among the block's rows of the digit. No task sees more than a
block's rows of a digit at a time, however many rows share a score, and after the last pass the place is the rank.
Only bits in which the keys differ are sorted by.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import Scratch, map_texts, sized_join, table, use_text_batches

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42
#: Bits of a digit at most, and of the places in a block: the offsets of a pass have a row per digit and block.
DIGIT_BITS = 11
BLOCK_BITS = 20
#: The offsets of a pass are copied to the executors up to so many counted rows (24 bytes each).
COPIED_OFFSETS = 1_000_000

#: Bytes of words: digits, letters with A-Z lower-cased, and all bytes of characters beyond ASCII; others separate.
_WORD_BYTES = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Matches of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in UTF-8, with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def buckets_of(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every run of one to three words joined by spaces; a run's crc32 goes on from the shorter run's."""
    runs = [list(map(zlib.crc32, words))]
    follow = [b" " + w for w in words]
    for k in range(1, LONGEST_RUN):
        runs.append(list(map(zlib.crc32, follow[k:], runs[-1])))
    return np.fromiter(chain(*runs), np.int64, sum(map(len, runs))) % buckets


def feature_counts(df: DataFrame, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts. A task adds up its own texts, so at most ``buckets`` rows leave it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(buckets_of(words_of(text), buckets), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit], pa.int64())], names=["bucket", "n"])

    rows = df.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, np.int64)
    for r in rows:
        counts[r.bucket] = r.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` of every bucket, in doubles."""
    b, big_s, big_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (big_s + b) / ((s + 1) * (big_t + b))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths from the id alone; a null id counts as an empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, seed: int = SEED) -> DataFrame:
    """(id_col, n_words, n_features, weight, score) of every row."""
    def make():
        def work(batch):
            out: dict[str, list] = {"doc_id": batch["doc_id"], "n_words": [], "n_features": [], "weight": [], "score": []}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = words_of(text)
                at = buckets_of(words, len(gain))
                weight = int(gain[at].sum())
                for name, value in (("n_words", len(words)), ("n_features", len(at)), ("weight", weight), ("score", weight + noise(doc_id, seed))):
                    out[name].append(value)
            return out

        return work

    fields = [(n, T.LongType()) for n in ("doc_id", "n_words", "n_features", "weight", "score")]
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(named, ["doc_id", "text"], fields, make).withColumnRenamed("doc_id", id_col)


def radix_sort(scratch: Scratch, rows: DataFrame, keys: list[Column], digit_bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``rows`` with ``pos``, their 0-based place in ascending order of ``keys`` (most significant first).

    Keys are longs without nulls, compared as unsigned 64-bit numbers; equal keys keep the order they were written in.
    """
    columns = rows.columns
    current = scratch.stage(rows.withColumn("pos", F.monotonically_increasing_id()), "pass-0")
    bits = current.agg(*(f(k).alias(f"{name}{i}") for i, k in enumerate(keys) for name, f in (("any", F.bit_or), ("all", F.bit_and)))).first()
    passes = []
    for i in reversed(range(len(keys))):
        differ = 0 if bits[f"any{i}"] is None else (bits[f"any{i}"] ^ bits[f"all{i}"]) & (2 ** 64 - 1)
        length = differ.bit_length()
        width = -(-length // max(1, -(-length // digit_bits)))
        passes += [(keys[i], shift, width) for shift in range(0, length, width or 1) if (differ >> shift) & (2 ** width - 1)]
    for key, shift, width in passes or [(F.lit(0).cast("long"), 0, 1)]:     # equal keys alone still need dense places
        marked = current.withColumns({"_digit": F.shiftrightunsigned(key, shift).bitwiseAND(F.lit(2 ** width - 1)),
                                      "_block": F.shiftright("pos", block_bits)})
        counts = scratch.stage(marked.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("n")), "counts")
        # at most 2^digit_bits digits in the first window, and one digit's blocks in each partition of the second
        earlier = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
        digits = counts.groupBy("_digit").agg(F.sum("n").alias("n")).select("_digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base"))
        ahead = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.join(F.broadcast(digits), "_digit").select(
            "_digit", "_block", (F.col("_base") + F.coalesce(F.sum("n").over(ahead), F.lit(0))).alias("_start"))
        within = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("pos")) - 1
        moved = sized_join(marked, offsets, ["_digit", "_block"], "inner", COPIED_OFFSETS).select(
            *columns, (F.col("_start") + within).alias("pos"))
        current = scratch.stage(moved, "pass")
    return current


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             min_words: int = MIN_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """(id_col, n_features, weight, score, rank) of every row; ``rank`` is null for rows that are not drawn.

    Ids are whole numbers. Null and empty texts have no features, weight 0 and are never drawn. Of equal scores the
    smaller id goes first, a null id last; repeated rows have equal keys and ranks of their own in the order they were
    read. Without target texts all gains follow from smoothing alone. Other columns are not read; an empty table gives
    an empty result. The returned rows read two tables in the shared folder.
    """
    spark = docs.sparkSession
    use_text_batches(spark)
    gain = gains(feature_counts(docs, text_col), feature_counts(target, target_text))
    keep = Scratch(spark, "resampling-result")
    with Scratch(spark, "resampling") as scratch:
        scored = keep.stage(weigh(docs, gain, id_col, text_col, seed), "scored", keep=True)
        wanted = scored.where(F.col("n_words") >= min_words).drop("n_words")
        count = wanted.count()
        # as unsigned numbers: the flipped order of scores, null ids after all others, ids with their sign bit turned
        keys = [F.col("score").bitwiseXOR(F.lit(2 ** 63 - 1)), F.col(id_col).isNull().cast("long"),
                F.coalesce(F.col(id_col), F.lit(0)).bitwiseXOR(F.lit(-2 ** 63))]
        placed = keep.stage(radix_sort(scratch, wanted, keys).select(
            id_col, "n_features", "weight", "score", F.when(F.col("pos") < percent * count // 100, F.col("pos") + 1).alias("rank")), "placed", keep=True)
    rest = scored.where(F.col("n_words") < min_words).select(id_col, "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return placed.unionByName(rest)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
