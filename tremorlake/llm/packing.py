"""Packing into optimal length buckets.

Lengths are encoded tokens (``pack_tokens``) or what the caller gives. Their global histogram goes to a dynamic program that chooses the bucket boundaries with the least padding.
Inside a bucket, documents are numbered and cut into batches that fill a token budget at the bucket's length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tremorlake.llm.bpe import document_lengths
from tremorlake.llm.common import WORD_PATTERN, Scratch, table

MAX_LENGTH = 4096
BUCKETS = 16
TOKEN_BUDGET = 32768
#: Rows of one numbering shard, so that no task numbers a whole bucket.
SHARD_ROWS = 20_000


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most ``buckets`` upper bounds, the last the longest length, with the least total padding; ties to the left.

    cost(i, j) pads all lengths i..j to length j. One row of the program is a minimum over all previous ends, taken
    for every j at once; lengths are distinct and bounded by the context, so the table is small.
    """
    n = len(lengths)
    if n == 0:
        return []
    docs = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.int64)
    buckets = min(buckets, n)
    best = lengths * docs[1:] - tokens[1:]
    choice = [np.zeros(n, np.int64)]
    for _ in range(1, buckets):
        nxt, frm = best.copy(), np.full(n, -1, np.int64)
        for j in range(1, n):
            # the bucket before ends at i, this one holds i + 1 .. j
            total = best[:j] + lengths[j] * (docs[j + 1] - docs[1:j + 1]) - (tokens[j + 1] - tokens[1:j + 1])
            i = int(total.argmin())
            if total[i] < nxt[j]:
                nxt[j], frm[j] = total[i], i
        best = nxt
        choice.append(frm)
    bounds, j, k = [], n - 1, buckets - 1
    while True:
        while k > 0 and choice[k][j] < 0:
            k -= 1
        bounds.append(int(lengths[j]))
        if k == 0:
            break
        j, k = int(choice[k][j]), k - 1
    return bounds[::-1]


def word_length(text_col: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text_col, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def pack(
    docs: DataFrame, length: Column | None = None, id_col: str = "doc_id", max_length: int = MAX_LENGTH, buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """One row per piece: id_col, piece, start, n_tokens, bucket_length, batch_id, slot.

    A document longer than ``max_length`` becomes pieces of that length and a remainder, none is cut short. Documents
    of length 0 (null, empty or blank texts) have no piece. ``batch_id`` is unique over all buckets; a batch holds at
    most max(1, ``budget`` // bucket_length) pieces, only the last batch of a bucket may be short of that.
    ``length`` defaults to the number of words in ``text``; ``pack_tokens`` gives encoded lengths. Null and repeated ids are carried through, each row for
    itself; an empty table gives an empty result.

    What reaches the driver: the histogram (at most ``max_length`` rows) and the shard counts, one row per
    ``SHARD_ROWS`` pieces and bucket.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    sized = docs.select(F.col(id_col), (word_length() if length is None else length).cast("long").alias("length"))
    rows = scratch.stage(sized.where("length > 0").withColumn("row", F.monotonically_increasing_id()), "lengths", keep=True)
    whole = F.floor((F.col("length") - 1) / max_length)
    pieces = rows.select(id_col, "row", "length", F.explode(F.sequence(F.lit(0).cast("long"), whole)).alias("piece")).select(
        id_col, "row", "piece", (F.col("piece") * max_length).alias("start"),
        F.least(F.lit(max_length), F.col("length") - F.col("piece") * max_length).alias("n_tokens"))
    histogram = sorted((r.n_tokens, r.n) for r in pieces.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    lengths, counts = (np.array([r[i] for r in histogram], np.int64) for i in (0, 1))
    bounds = best_boundaries(lengths, counts, buckets)
    if not bounds:
        return pieces.drop("row").withColumn("bucket_length", F.col("n_tokens")).withColumn("batch_id", F.lit(0).cast("long")).withColumn(
            "slot", F.lit(0).cast("long"))
    per_bucket = {b: int(counts[(lengths > low) & (lengths <= b)].sum()) for low, b in zip([0, *bounds], bounds)}
    return _batches(pieces, id_col, per_bucket, budget)


def _batches(pieces: DataFrame, id_col: str, per_bucket: dict[int, int], budget: int) -> DataFrame:
    bounds = list(per_bucket)
    bucket = F.lit(bounds[-1])
    shards, batches = F.lit(1), F.lit(0)
    first = 0
    for b in reversed(bounds[:-1]):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(bucket)
    for b in bounds:
        shards = F.when(F.col("bucket_length") == b, F.lit(1 + per_bucket[b] // SHARD_ROWS)).otherwise(shards)
        batches = F.when(F.col("bucket_length") == b, F.lit(first)).otherwise(batches)
        first += -(-per_bucket[b] // max(1, budget // b))
    placed = pieces.withColumn("bucket_length", bucket.cast("long")).withColumn(
        "shard", F.pmod(F.xxhash64("row", "piece"), shards.cast("long")))
    held = placed.groupBy("bucket_length", "shard").agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy("bucket_length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("bucket_length", "shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket_length", "shard").orderBy("row", "piece")
    numbered = placed.withColumn("nth", F.row_number().over(inside) - 1).join(offsets, ["bucket_length", "shard"])
    place = F.col("offset") + F.col("nth")
    capacity = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("bucket_length")))
    return numbered.select(
        id_col, "piece", "start", "n_tokens", "bucket_length", (batches.cast("long") + F.floor(place / capacity)).alias("batch_id"),
        (place % capacity).alias("slot"))


def pack_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``pack``, with lengths, limit, budget and the places of pieces in byte-level BPE tokens of the whole text.

    Piece ``k`` holds the token ids from ``start`` to ``start + n_tokens``. Texts of white space only have tokens, so
    they have pieces; null and empty texts have none.
    """
    return pack(document_lengths(docs, id_col, text_col), F.col("length"), id_col)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"))
