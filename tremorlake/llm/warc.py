"""WARC records in seekable Zstandard bundles.

Every task groups its records into independent frames and its frames into bundles. A bundle ends with a seek table, a
skippable frame of the seekable format: compressed and raw size of every frame, their number, a descriptor and a
magic number. A record is found by bundle, frame and the offset inside the frame's raw bytes; reading it touches that
frame alone. Bundles are rows of a table in the shared store, which any of Spark's file systems can hold;
``export_bundles`` gives them out as plain files.

Pages with equal payloads are one response, that of the largest id, and revisits that name it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tremorlake.llm.common import Scratch, sized_join, table, use_text_batches

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 16 << 20
LEVEL = 3
#: Digests of repeated payloads are copied to the executors up to this counted number (28 bytes each).
COPIED_DIGESTS = 1_000_000

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

#: Fixed value: all records carry one date, so that bundles of equal input are equal.
WARC_DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, kind: str, digest: str, size: int, refers_to: int | None, payload: bytes) -> bytes:
    """One WARC/1.1 record; a revisit has no payload and tells the size of the one it stands for. A null id is written empty."""
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {WARC_DATE}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def parse_record(raw: memoryview | bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, next offset) of the record at ``at``."""
    raw = bytes(raw) if isinstance(raw, memoryview) else raw
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, raw[start:stop], stop + 4


class Bundle:
    """Collects records into frames and frames into one bundle."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frame_bytes = frame_bytes
        self.parts: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.raw = bytearray()
        self.compressed = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in the frame) of the record."""
        if self.raw and len(self.raw) + len(data) > self.frame_bytes:
            self._flush()
        place = len(self.sizes), len(self.raw)
        self.raw += data
        return place

    def _flush(self) -> None:
        if self.raw:
            frame = self.compressor.compress(bytes(self.raw))
            self.parts.append(frame)
            self.sizes.append((len(frame), len(self.raw)))
            self.compressed += len(frame)
            self.raw = bytearray()

    def close(self) -> bytes:
        self._flush()
        entries = b"".join(struct.pack("<II", *size) for size in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        seek = struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer
        return b"".join(self.parts) + seek


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, raw size) of every frame, from the footer."""
    count, descriptor, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if descriptor & 0x80 else 8
    start = len(bundle) - 9 - count * entry
    frames, at = [], 0
    for n in range(count):
        compressed, raw = struct.unpack_from("<II", bundle, start + n * entry)
        frames.append((at, compressed, raw))
        at += compressed
    return frames


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    at, compressed, raw = frame
    return zstandard.ZstdDecompressor().decompress(bundle[at:at + compressed], max_output_size=max(raw, 1))


def read_record(bundle: bytes, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its place; only its frame is read."""
    headers, payload, _ = parse_record(read_frame(bundle, seek_table(bundle)[frame]), offset)
    return headers, payload


BUNDLES = "bundle_id string, bundle binary, page_ids array<bigint>, frames array<int>, offsets array<int>"


def write_bundles(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """A table of bundles with the record index of each, see ``BUNDLES``.

    Payload: the html in UTF-8, null as empty. Of records with equal payloads of ``min_bytes`` or more the one with the
    largest id is the response, the others are revisits. Rows that repeat an id keep one record each; of equal rows
    with the largest id all are responses. A null id is written empty and is a revisit where another row of the payload
    has an id. Null urls are written empty. An empty table gives an empty result; other columns are not read.

    Payloads stay in the tasks that read them: digests are counted first, and only those that repeat are looked up.
    """
    spark = pages.sparkSession
    use_text_batches(spark)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html")).withColumn("sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    repeated = Scratch(spark, "warc").stage(rows.where(F.octet_length("html") >= min_bytes).groupBy("sha").agg(
        F.max("id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "response"), "repeated", keep=True)
    joined = sized_join(rows, repeated, ["sha"], "left", COPIED_DIGESTS)
    revisit = F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    wanted = joined.select(
        "id", "url", "sha", F.octet_length("html").cast("long").alias("size"), F.when(revisit, F.col("response")).alias("refers_to"),
        F.when(~revisit, F.col("html").cast("binary")).alias("payload"))

    arrow = to_arrow_schema(T.StructType.fromDDL(BUNDLES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(bundle, places):
            data = bundle.close()
            # named by its content: a task that is run again makes the same bundle
            row = (hashlib.sha1(data).hexdigest(), data, [p[0] for p in places], [p[1] for p in places], [p[2] for p in places])
            return pa.RecordBatch.from_arrays([pa.array([x], type=arrow.field(i).type) for i, x in enumerate(row)], schema=arrow)

        bundle, places = Bundle(frame_bytes), []
        for batch in batches:
            for row in batch.to_pylist():
                digest = base64.b32encode(row["sha"]).decode()
                kind = "response" if row["refers_to"] is None else "revisit"
                data = record(row["id"], row["url"].replace("\r", "%0D").replace("\n", "%0A"), kind, digest, row["size"], row["refers_to"],
                              row["payload"] or b"")
                places.append((row["id"], *bundle.add(data)))
                if bundle.compressed + len(bundle.raw) >= bundle_bytes:
                    yield out(bundle, places)
                    bundle, places = Bundle(frame_bytes), []
        if places:
            yield out(bundle, places)

    return wanted.mapInArrow(run, BUNDLES)


def read_bundles(bundles: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, bundle_id, frame, frame_offset) of all records.

    Each bundle is read frame by frame; the index must name just the places where records begin. Sizes and digests of
    responses are taken from the payload read, those of revisits from their header.
    """
    schema = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
              "bundle_id string, frame int, frame_offset int")
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    use_text_batches(bundles.sparkSession, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(list(records(row)), schema=arrow)

    def records(row: dict) -> Iterator[dict]:
        bundle = row["bundle"]
        named = set(zip(row["page_ids"], row["frames"], row["offsets"]))
        for number, frame in enumerate(seek_table(bundle)):
            raw, at = read_frame(bundle, frame), 0
            while at < len(raw):
                headers, payload, following = parse_record(raw, at)
                name = headers["WARC-Record-ID"][len("<urn:page:"):-1]
                page_id = int(name) if name else None
                if (page_id, number, at) not in named:
                    raise ValueError(f"record {page_id} is not where the index has it")
                revisit = headers["WARC-Type"] == "revisit"
                yield {
                    "page_id": page_id,
                    "payload_bytes": int(headers["X-Payload-Length"]) if revisit else len(payload),
                    "payload_digest": headers["WARC-Payload-Digest"][len("sha1:"):] if revisit else payload_digest(payload),
                    "record_type": headers["WARC-Type"],
                    "refers_to": int(headers["WARC-Refers-To"][len("<urn:page:"):-1]) if revisit else None,
                    "bundle_id": row["bundle_id"], "frame": number, "frame_offset": at}
                at = following

    return bundles.select("bundle_id", "bundle", "page_ids", "frames", "offsets").mapInArrow(run, schema)


def export_bundles(bundles: DataFrame, folder: str) -> DataFrame:
    """Write every bundle as ``<bundle_id>.warc.zst`` into a mounted folder that all executors share; (bundle_id, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for row in batch.to_pylist():
                path = os.path.join(folder, f"{row['bundle_id']}.warc.zst")
                with open(f"{path}.part", "wb") as file:
                    file.write(row["bundle"])
                os.replace(f"{path}.part", path)
            yield pa.RecordBatch.from_pylist(
                [{"bundle_id": r["bundle_id"], "bytes": len(r["bundle"])} for r in batch.to_pylist()],
                schema=pa.schema([("bundle_id", pa.string()), ("bytes", pa.int64())]))

    return bundles.select("bundle_id", "bundle").mapInArrow(run, "bundle_id string, bytes bigint")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = Scratch(spark, "warc").stage(write_bundles(table(spark, sf_dir, "pages")), "bundles", keep=True)
    return read_bundles(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
