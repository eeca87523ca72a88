import glob
import hashlib
import base64

import zstandard

from quarry.llm import warc
from quarry.llm.common import new_folder

SCHEMA = "page_id long, url string, html string, payload string, n int"
ROWS = [
    (5, "http://a", "same"), (2, "http://b", "same"), (9, None, "same"), (3, "http://c", None), (4, "http://d", ""),
    (7, "http://e\r\nX: y", "é" * 300_000), (2, "http://b", "same"), (None, "http://f", "same"), (8, "http://g", "other\r\n\r\nWARC/1.1"),
]


def pages(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in ROWS], SCHEMA)


def test_round_trip(spark):
    path = new_folder(spark, "warc-test")
    warc.write_archives(pages(spark).repartition(3), path, frame_bytes=1 << 16)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(ROWS)
    kinds = sorted((r["record_id"], r["record_type"], r["refers_to"]) for r in got)
    name = "urn:page:{}".format
    assert kinds == sorted([
        (name(5), "revisit", name(2)), (name(2), "response", None), (name(2), "response", None), (name(9), "revisit", name(2)),
        (name(""), "revisit", name(2)), (name(3), "response", None), (name(4), "revisit", name(3)), (name(7), "response", None), (name(8), "response", None),
    ])
    texts = {f"urn:page:{i if i is not None else ''}": (h or "").encode() for i, _, h in ROWS}
    for r in got:
        data = texts[r["record_id"]]
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["payload"] == (data if r["record_type"] == "response" else None)


def test_small_payloads_are_never_revisits(spark):
    path = new_folder(spark, "warc-test")
    warc.write_archives(pages(spark), path, revisit_min_bytes=5)
    assert {r["record_type"] for r in warc.read_archives(spark, path).collect()} == {"response"}


def test_files_are_seekable_zstandard(spark):
    path = new_folder(spark, "warc-test")
    warc.write_archives(pages(spark).coalesce(1), path, frame_bytes=1 << 10)
    file = max(glob.glob(f"{path}/part-*"), key=lambda f: len(open(f, "rb").read()))
    content = open(file, "rb").read()
    assert content[-4:] == warc.SEEKABLE_MAGIC.to_bytes(4, "little")
    whole = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert whole.startswith(b"WARC/1.1\r\n")
    index = warc.read_index(spark, path)
    assert index.count() == len(ROWS)
    at = 0
    for (start, packed, unpacked), entries in warc.frame_places(content):
        data = zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=unpacked)
        assert whole[at : at + unpacked] == data
        for record_id, offset, length in entries:
            assert warc.parse_record(data[offset : offset + length])[0]["warc-record-id"] == f"<{record_id}>"
        at += unpacked
    assert at == len(whole)


def test_fetch_and_empty(spark):
    path = new_folder(spark, "warc-test")
    warc.write_archives(pages(spark), path, frame_bytes=1)
    ids = spark.createDataFrame([("urn:page:7",), ("urn:page:404",)], "record_id string")
    assert [r["record_id"] for r in warc.fetch_records(spark, path, ids).collect()] == ["urn:page:7"]
    none = new_folder(spark, "warc-test")
    warc.write_archives(pages(spark).filter("false"), none)
    assert warc.read_archives(spark, none).count() == 0 and warc.read_index(spark, none).count() == 0
