"""Byte-level BPE with the tiktoken library and a local rank file, and exact statistics of encoded lengths.

Long texts are cut at safe boundaries before the library sees them: between a character that is not white space
and white space no match of the pattern continues, so both sides are matched as before. Very long runs of white space,
which would overflow the stack of the library's pattern engine, are split where the pattern itself would split them.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import Scratch, map_texts, table, use_text_batches

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Texts above this length are cut; the pieces are at least so long where boundaries allow.
PIECE_CHARS = 50_000
#: A run of white space above this length is matched by rule instead of by the pattern engine.
LONG_RUN = 5_000

#: The characters with the Unicode property White_Space, which the pattern's \s means.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BOUNDARY = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")
_LONG_SPACE = re.compile(f"[{_SPACE}]{{{LONG_RUN},}}")

_encodings: dict[tuple[str, str], object] = {}


def encoding(rank_path: str, pattern: str):
    """The encoding of a rank file, built once per Python process."""
    key = (rank_path, pattern)
    if key not in _encodings:
        import tiktoken

        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Consecutive parts of ``text``, each cut where no match of the pattern continues."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(enc, text: str) -> list[int]:
    """Token ids of ``text``, special tokens read as ordinary text."""
    if len(text) < LONG_RUN:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece in safe_pieces(text):
        # white space before a non-space gives its last character to what follows; at the end it is one match
        at = 0
        for run in _LONG_SPACE.finditer(piece):
            end = run.end() if run.end() == len(piece) else run.end() - 1
            ids.extend(_ordinary(enc, piece[at:run.start()]))
            ids.extend(enc._encode_single_piece(piece[run.start():end]))
            at = end
        ids.extend(_ordinary(enc, piece[at:]))
    return ids


def _ordinary(enc, text: str) -> list[int]:
    return enc.encode_ordinary(text) if text else []


def _local_ranks(rank_path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return rank_path or public_tokenizers.path(RANK_FILE), pattern or public_tokenizers.PATTERN


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank_path: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """(id_col, ids, decoded): token ids of every whole text and the bytes they decode to.

    Null texts count as empty: no ids, no bytes. Null and repeated ids are carried through, each row for itself.
    Other columns are not read; an empty table gives an empty result. The rank file is read where the task runs.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    use_text_batches(docs.sparkSession)

    def make():
        enc = encoding(*_local_ranks(rank_path, pattern))

        def work(batch):
            ids = [encode(enc, text or "") for text in batch["text"]]
            return {id_col: batch["id"], "ids": ids, "decoded": [enc.decode_bytes(x) for x in ids]}

        return work

    return map_texts(named, ["id", "text"], [
        (id_col, docs.schema[id_col].dataType), ("ids", T.ArrayType(T.IntegerType())), ("decoded", T.BinaryType())], make)


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """As ``encode_documents``, but each document's ids and bytes leave the task as count and digests only."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    use_text_batches(docs.sparkSession)

    def make():
        enc = encoding(*_local_ranks(rank_path, pattern))
        decimal = [b"%d" % i for i in range(enc.n_vocab)]

        def work(batch):
            n, of_ids, of_bytes = [], [], []
            for text in batch["text"]:
                ids = encode(enc, text or "")
                n.append(len(ids))
                of_ids.append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest())
                of_bytes.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            return {id_col: batch["id"], "n_tokens": n, "ids_sha256": of_ids, "decoded_sha256": of_bytes}

        return work

    return map_texts(named, ["id", "text"], [
        (id_col, docs.schema[id_col].dataType), ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()),
        ("decoded_sha256", T.StringType())], make)


def token_lengths(docs: DataFrame, text_col: str = "text", rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(length, docs): encoded lengths, added up inside every batch before anything is shuffled."""
    use_text_batches(docs.sparkSession)

    def make():
        from collections import Counter

        enc = encoding(*_local_ranks(rank_path, pattern))

        def work(batch):
            held = Counter(len(encode(enc, text or "")) for text in batch["text"])
            return {"length": list(held.keys()), "docs": list(held.values())}

        return work

    return map_texts(docs.select(F.col(text_col).alias("text")), ["text"], [("length", T.LongType()), ("docs", T.LongType())], make)


def document_lengths(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank_path: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """(id_col, length): the encoded length of every whole text, 0 for null; only lengths leave the task."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    use_text_batches(docs.sparkSession)

    def make():
        enc = encoding(*_local_ranks(rank_path, pattern))
        return lambda batch: {id_col: batch["id"], "length": [len(encode(enc, text or "")) for text in batch["text"]]}

    return map_texts(named, ["id", "text"], [(id_col, docs.schema[id_col].dataType), ("length", T.LongType())], make)


BLOCK = 1024


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Per encoded length: documents, and what suffix sums tell of a context limit of just that length.

    Columns: length, docs, tokens; docs_over and tokens_over (documents longer than the limit and their tokens);
    truncated_tokens (tokens kept when every document is cut to the limit); total_docs, total_tokens; rank_low and
    rank_high (positions, from 1, that documents of this length take in the order of lengths: a quantile q is the
    length whose positions hold ceil(q * total_docs)). Between two lengths of the table truncated_tokens is linear:
    that of the smaller length plus docs_over for every further token.

    Suffix sums run in two steps, over blocks of ``BLOCK`` lengths and inside each block, so no window spans all
    lengths. An empty table gives an empty result.
    """
    from pyspark.sql.window import Window

    per = lengths.groupBy("length").agg(F.sum("docs").alias("docs")).withColumn("tokens", F.col("length") * F.col("docs")).withColumn(
        "block", F.floor(F.col("length") / BLOCK))
    blocks = per.groupBy("block").agg(F.sum("docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    # one row per block of lengths: a single short text more or less changes nothing, only the longest text counts
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = blocks.select(
        "block", F.coalesce(F.sum("b_docs").over(later), F.lit(0)).alias("d"), F.coalesce(F.sum("b_tokens").over(later), F.lit(0)).alias("t"),
        F.sum("b_docs").over(everything).alias("total_docs"), F.sum("b_tokens").over(everything).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    joined = per.join(after, "block").withColumn(
        "docs_over", F.col("d") + F.coalesce(F.sum("docs").over(inside), F.lit(0))).withColumn(
        "tokens_over", F.col("t") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return joined.select(
        "length", "docs", "tokens", "docs_over", "tokens_over",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("truncated_tokens"),
        "total_docs", "total_tokens", (F.col("total_docs") - F.col("docs_over") - F.col("docs") + 1).alias("rank_low"),
        (F.col("total_docs") - F.col("docs_over")).alias("rank_high"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "lengths")
    counted = scratch.stage(token_lengths(table(spark, sf_dir, "documents")).groupBy("length").agg(
        F.sum("docs").alias("docs")), "lengths", keep=True)
    return length_histogram(counted)
