"""Quality rules: counts of one text, and how often its lines stand in other documents of the same host.

Lines are normalised (A-Z lower-cased, digits as 0, white space runs as one space) and hashed. A line is over the
limit of its host when more distinct documents of that host hold it than ``LINE_FLOOR`` and ``LINE_SHARE`` of the
host's documents. Lines over the limit are removed; a document of which too little is left is rejected.

Exact copies are not evidence that a line is boilerplate. Documents are therefore counted, for line and host alike, by
a 64-bit digest of all their words in order (A-Z lower-cased, digits as they stand): texts with the same words count
once, texts that differ in any word count each. Near copies differ in words, so they count each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import SPACES, Scratch, hash_words, map_texts, sized_join, table, use_text_batches, windows

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
LINE_FLOOR = 20
LINE_SHARE = 0.05
MIN_WORDS_LEFT = 10
MIN_PERCENT_LEFT = 30
#: Boilerplate lines (host, hash) are copied to the executors up to this counted number.
COPIED_LINES = 500_000

_NORMAL = bytes.maketrans(b"123456789", b"0" * 9)


def repeated_words(hashes: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more, its first place included."""
    if len(hashes) <= window:
        return 0
    _, inverse, counts = np.unique(windows(hashes, window), return_inverse=True, return_counts=True)
    places = np.flatnonzero(counts[inverse] >= 2)
    if not len(places):
        return 0
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def text_counts(text: str | None) -> dict:
    """Counts of one text, its lines as (hash, words), and the digest of its words; all zero for null or blank texts."""
    import xxhash

    if not text:
        return {"n_words": 0, "word_chars": 0, "n_symbols": 0, "n_dup_lines": 0, "n_repeat_words": 0, "lines": [], "digest": 0}
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    hashes = hash_words(words)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    held: dict[int, int] = {}
    for line in raw.lower().translate(_NORMAL).split(b"\n"):
        parts = line.split()
        if parts:
            key = xxhash.xxh3_64_intdigest(b" ".join(parts)) - (1 << 63)
            held[key] = held.get(key, 0) + len(parts)
    digest = xxhash.xxh3_64_intdigest(b" ".join(words).lower()) - (1 << 63) if words else 0
    return {
        "n_words": len(words), "word_chars": len(text) - sum(map(text.count, SPACES)),
        "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(hashes), "lines": [{"line": k, "words": n} for k, n in held.items()], "digest": digest}


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counted(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    fields = [(id_col, docs.schema[id_col].dataType), ("host", T.StringType()), *((c, T.LongType()) for c in COUNTS),
              ("lines", T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("words", T.LongType())]))),
              ("digest", T.LongType())]

    def make():
        def work(batch):
            rows = [text_counts(text) for text in batch["text"]]
            out = {name: [r[name] for r in rows] for name in (*COUNTS, "lines", "digest")}
            return {**out, id_col: batch["id"], "host": ["" if h is None else str(h) for h in batch["host"]]}

        return work

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(host_col).cast("string").alias("host"))
    return map_texts(named, ["id", "text", "host"], fields, make)


def lines_over_limit(lines: DataFrame, hosts: DataFrame, floor: int, share: float) -> DataFrame:
    """(host, line) of the lines that more distinct documents of a host hold than its limit."""
    often = (lines.select("host", "line", "digest").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("held"))
             .where(F.col("held") > floor))
    per_host = hosts.distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    return often.join(per_host, "host").where(F.col("held") > share * F.col("host_docs")).select("host", "line")


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    floor: int = LINE_FLOOR, share: float = LINE_SHARE, min_left: int = MIN_WORDS_LEFT, percent_left: int = MIN_PERCENT_LEFT,
) -> DataFrame:
    """One row per row of ``docs``: id, counts, base_failed, kept and n_words_left.

    Words are ``[^\\x20\\x09-\\x0D]+``. base_failed: fewer than 20 words, or more than 30 percent of the words in
    repeated 8-word windows. kept: not base_failed, and after the removal of lines over the limit at least
    ``min_left`` words and ``percent_left`` percent of the words are left.

    Null and empty texts count zero everywhere and fail the base rules. A null host is a host of its own. Null and
    repeated ids are carried through, each row for itself. An empty table gives an empty result; other columns are
    not read, whatever their names.
    """
    spark = docs.sparkSession
    use_text_batches(spark)
    scratch = Scratch(spark, "quality")
    rows = scratch.stage(
        counted(docs, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id()), "counts", keep=True)
    lines = rows.where("n_words > 0").select("row", "host", "digest", F.explode("lines").alias("l")).select(
        "row", "host", "digest", "l.line", "l.words")
    over = scratch.stage(
        lines_over_limit(lines, rows.where("n_words > 0").select("host", "digest"), floor, share), "over", keep=True)
    removed = sized_join(lines.select("row", "host", "line", "words"), over, ["host", "line"], "inner", COPIED_LINES).groupBy(
        "row").agg(F.sum("words").alias("removed"))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    failed = base_failed()
    return rows.select("row", id_col, *COUNTS).join(removed, "row", "left").select(
        id_col, *COUNTS, failed.alias("base_failed"),
        (~failed & (left >= min_left) & (100 * left >= percent_left * F.col("n_words"))).alias("kept"),
        left.alias("n_words_left"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
