import base64
import hashlib

import zstandard
from pyspark.sql import functions as F

from tremorlake.llm.common import Scratch
from tremorlake.llm.warc import Bundle, export_bundles, op5_warc, parse_record, read_bundles, read_record, record, seek_table, write_bundles

from fixtures import CLASHING, SF_DIR


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows):
    top = {}
    for i, html in rows:
        key = (html or "").encode()
        top[key] = max(i, top.get(key, i))
    return {i: (len((html or "").encode()), digest((html or "").encode()), "response" if top[(html or "").encode()] == i else "revisit",
                None if top[(html or "").encode()] == i else top[(html or "").encode()]) for i, html in rows}


def as_rows(df):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()}


def test_pages_round_trip(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    assert as_rows(op5_warc(spark, SF_DIR)) == expected(rows)


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "é\r\n\r\nWARC/1.1"), (4, "é\r\n\r\nWARC/1.1"), (5, "same"), (6, "same"), (7, "x" * 3_000_000), (8, "\x00"), (0, "same")]
    df = spark.createDataFrame([(i, None if i == 3 else "http://h/\r\n: x", h) for i, h in rows], "page_id long, url string, html string")
    for name in CLASHING:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    bundles = Scratch(spark, "t").stage(write_bundles(df, frame_bytes=1000, bundle_bytes=5000), "bundles", keep=True)
    assert as_rows(read_bundles(bundles)) == expected(rows)
    one_null = spark.createDataFrame([(None, "u", "p"), (9, "u", "q"), (9, "u", "q")], "page_id long, url string, html string")
    got = read_bundles(Scratch(spark, "t").stage(write_bundles(one_null), "bundles", keep=True)).collect()
    assert sorted((str(r.page_id), r.record_type) for r in got) == [("9", "response"), ("9", "response"), ("None", "response")]
    ids = spark.createDataFrame([(None, "u", "p"), (-1, "u", "p"), (None, "u", "q"), (None, "u", "q"), (-1, "u", "r")], "page_id long, url string, html string")
    got = read_bundles(Scratch(spark, "t").stage(write_bundles(ids), "bundles", keep=True)).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in got if r.refers_to is None) == [
        ("-1", "response", None)] * 2 + [("None", "response", None)] * 2
    assert [(r.page_id, r.record_type, r.refers_to) for r in got if r.refers_to is not None] == [(None, "revisit", -1)]
    assert read_bundles(write_bundles(df.limit(0))).count() == 0


def test_payloads_stay_where_they_are_read(spark):
    plan = write_bundles(spark.read.parquet(f"{SF_DIR}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_smaller_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = as_rows(read_bundles(Scratch(spark, "t").stage(write_bundles(df, min_bytes=3), "bundles", keep=True)))
    assert [got[i][2] for i in (1, 2, 3, 4)] == ["response", "response", "revisit", "response"] and got[3][3] == 4


def test_one_record_is_read_by_its_place():
    bundle, places = Bundle(frame_bytes=300), []
    for i in range(20):
        payload = f"<p>{i}</p>".encode()
        places.append(bundle.add(record(i, "u", "response", digest(payload), len(payload), None, payload)))
    data = bundle.close()
    assert len(seek_table(data)) > 5 and len({f for f, _ in places}) == len(seek_table(data))
    for i, (frame, offset) in enumerate(places):
        assert read_record(data, frame, offset)[1] == f"<p>{i}</p>".encode()
    # any reader of Zstandard skips the seek table
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert parse_record(whole)[0]["WARC-Record-ID"] == "<urn:page:0>" and whole.count(b"WARC/1.1\r\n") == 20


def test_export(spark, tmp_path):
    bundles = Scratch(spark, "t").stage(write_bundles(spark.read.parquet(f"{SF_DIR}/pages.parquet")), "bundles", keep=True)
    sizes = {r.bundle_id: r.bytes for r in export_bundles(bundles, str(tmp_path / "out")).collect()}
    assert {p.name: p.stat().st_size for p in (tmp_path / "out").iterdir()} == {f"{k}.warc.zst": v for k, v in sizes.items()}
