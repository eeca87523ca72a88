"""WARC records in seekable Zstandard bundles.

A bundle is one file. Its records are grouped into independent Zstandard frames. Every
frame is followed by a skippable frame that maps the record identifiers of the frame to
(offset, length) inside the decompressed frame, and the file ends with the seek table of
the public seekable format (a skippable frame with the sizes of all frames). A reader
gets one record by decompressing one frame; a plain Zstandard decoder reads the whole file
as one WARC stream.

Files are written by Spark's own text sink and its committer, so they can go to any file
system that Spark knows, and lost tasks are retried: one row is one piece of the file, and
the sink's line separator is the seekable format's magic number. It is the last field of
the file there, and between frames it is the tail of the skippable index frame.

Bundles follow the shuffle partitions of the plan, so adaptive execution sets their size
(`spark.sql.adaptive.advisoryPartitionSizeInBytes`). A task holds one frame when writing
and one file when reading.
"""

import json
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from quarry.llm.common import attach, stored

# Zstandard skippable frames and the seekable format.
SKIPPABLE, SEEK_TABLE, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
MAGIC_TEXT = SEEKABLE_MAGIC.to_bytes(4, "little").decode("latin-1")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = (
    "path string, frame int, frame_offset long, record_id string, record_type string, url string, date string, "
    "payload_digest string, payload_bytes long, refers_to string, payload binary"
)
ARROW_RECORD = pa.schema([
    ("path", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("record_id", pa.string()),
    ("record_type", pa.string()), ("url", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary()),
])


def base32_sha1(payload):
    """Upper-case base32 of the SHA-1 of a binary column, from built-in functions."""
    digest = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def header_value(text):
    """One header line's value: line breaks would start a new header."""
    return " ".join((text or "").split("\n")).replace("\r", " ")


def warc_record(record, date):
    """The bytes of one record."""
    kind, url = record["record_type"], header_value(record["url"])
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {record['payload_bytes']}"]
    block = ("\r\n".join(head) + "\r\n\r\n").encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record['record_id']}>", f"WARC-Date: {date}"]
    if record["url"] is not None:
        lines.append(f"WARC-Target-URI: {url}")
    lines += [f"WARC-Payload-Digest: sha1:{record['payload_digest']}", f"X-Payload-Length: {record['payload_bytes']}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{record['refers_to']}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    else:
        block += record["payload"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data):
    """(headers by lower-case name, payload) of one record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    headers = {k.lower(): v for k, v in headers.items()}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def bundle_pieces(records, date, frame_bytes, level):
    """The file's pieces; the sink adds the magic number after each of them."""
    packer, sizes, frame, index, filled = zstandard.ZstdCompressor(level=level), [], [], [], 0

    def close():
        packed, ids = packer.compress(b"".join(frame)), json.dumps(index).encode()
        sizes.extend([(len(packed), filled), (8 + len(ids) + 4, 0)])
        return packed + struct.pack("<II", SKIPPABLE, len(ids) + 4) + ids

    for record in records:
        data = warc_record(record, date)
        if frame and filled + len(data) > frame_bytes:
            yield close()
            frame, index, filled = [], [], 0
        index.append((record["record_id"], filled, len(data)))
        frame.append(data)
        filled += len(data)
    if frame:
        yield close()
    if sizes:
        table = b"".join(struct.pack("<II", *s) for s in sizes)
        yield struct.pack("<II", SEEK_TABLE, len(table) + 9) + table + struct.pack("<IB", len(sizes), 0)


def frame_places(content):
    """(start of the packed frame, its index entries) for every data frame of a file."""
    if not content:
        return
    count, _, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    entries = struct.iter_unpack("<II", content[len(content) - 9 - 8 * count : len(content) - 9])
    at, start = 0, None
    for packed, unpacked in entries:
        if struct.unpack_from("<I", content, at)[0] == SKIPPABLE:
            yield start, json.loads(content[at + 8 : at + packed - 4])
        else:
            start = (at, packed, unpacked)
        at += packed


def file_records(path, content, wanted=None):
    """Records of a file; with `wanted` (frame numbers) only those frames are decompressed."""
    unpacker = zstandard.ZstdDecompressor()
    for number, ((at, packed, unpacked), index) in enumerate(frame_places(content)):
        if wanted is not None and number not in wanted:
            continue
        data = unpacker.decompress(content[at : at + packed], max_output_size=max(unpacked, 1))
        for _, offset, length in index:
            headers, payload = parse_record(data[offset : offset + length])
            bare = {k: v.strip("<>") for k, v in headers.items()}
            yield {
                "path": path, "frame": number, "frame_offset": offset, "record_id": bare["warc-record-id"],
                "record_type": headers["warc-type"], "url": headers.get("warc-target-uri"), "date": headers["warc-date"],
                "payload_digest": headers["warc-payload-digest"].removeprefix("sha1:"),
                "payload_bytes": int(headers["x-payload-length"]), "refers_to": bare.get("warc-refers-to"),
                "payload": payload if headers["warc-type"] == "response" else None,
            }


def in_batches(rows, schema, limit=16 << 20):
    """Arrow batches of about `limit` payload bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["payload"] or b"") + 200
        if size >= limit:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def plan_records(df, key, url, payload, prefix, revisit_min_bytes):
    """One row per record to write: identifiers, digest, kind, and the payload of responses."""
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), data.alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    same = rows.filter(F.col("payload_bytes") >= revisit_min_bytes).groupBy("payload_digest")
    same = same.agg(F.min("key").alias("first_key"), F.count("*").alias("n")).filter("n > 1 AND first_key IS NOT NULL")
    rows = attach(rows, stored(same), ["payload_digest"], ["key", "url"])
    revisit = F.col("first_key").isNotNull() & ~F.col("key").eqNullSafe(F.col("first_key"))
    name = lambda c: F.concat(F.lit(prefix), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.select(
        name("key").alias("record_id"), "url", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, name("first_key")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(
    df, path, key="page_id", url="url", payload="html", prefix="urn:page:", revisit_min_bytes=0,
    frame_bytes=1 << 20, level=3, date="1970-01-01T00:00:00Z",
):
    """Write one record per row of `df` below `path`.

    Of the rows with equal payloads of at least `revisit_min_bytes`, those with the smallest
    key are responses and the others revisit them; repeated rows with that key are all
    responses. A null key comes after all others (all keys null: all are responses) and is
    named `prefix`. A null payload is empty. A null url leaves the header out. A record larger
    than `frame_bytes` gets a frame of its own. An empty table writes no frames. Other columns
    of `df` are ignored.
    """
    planned = plan_records(df, key, url, payload, prefix, revisit_min_bytes)

    def pieces(batches):
        records = (record for batch in batches for record in batch.to_pylist())
        for piece in bundle_pieces(records, date, frame_bytes, level):
            yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.binary())})

    bundles = planned.mapInArrow(pieces, "piece binary").select(F.col("piece").cast("string"))
    bundles.write.option("lineSep", MAGIC_TEXT).option("encoding", "ISO-8859-1").text(path)


def open_bundles(spark, path):
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_archives(spark, path):
    """All records below `path`, see `RECORD_SCHEMA`; the payload is null for revisits."""

    def records(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from in_batches(file_records(row["path"], row["content"]), ARROW_RECORD)

    return open_bundles(spark, path).mapInArrow(records, RECORD_SCHEMA)


def read_index(spark, path):
    """(record_id, path, frame, frame_offset, length) of all records; decompresses nothing."""
    fields = [("record_id", pa.string()), ("path", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("length", pa.int64())]

    def entries(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for number, (_, index) in enumerate(frame_places(row["content"])):
                    values = [(i, row["path"], number, offset, length) for i, offset, length in index]
                    columns = [pa.array(c, f[1]) for c, f in zip(zip(*values), fields)]
                    yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return open_bundles(spark, path).mapInArrow(
        entries, "record_id string, path string, frame int, frame_offset long, length long"
    )


def fetch_records(spark, path, ids, record_id="record_id"):
    """The records whose identifiers are in `ids`; only the frames that hold one are decompressed."""
    wanted = ids.select(F.col(record_id).alias("record_id")).distinct()
    places = read_index(spark, path).join(wanted, "record_id").groupBy("path").agg(F.collect_set("frame").alias("frames"))

    def records(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from in_batches(file_records(row["path"], row["content"], set(row["frames"])), ARROW_RECORD)

    files = open_bundles(spark, path).join(places, "path").select("path", "content", "frames")
    return files.mapInArrow(records, RECORD_SCHEMA).join(wanted, "record_id", "left_semi")
