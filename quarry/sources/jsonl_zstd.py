"""JSON lines in Zstandard files, through Spark's own text sink and file sources.

A row of the sink is one Zstandard frame of whole lines. The sink ends every row with its line
separator, here an empty skippable frame, so a file is a plain Zstandard stream for any reader
(`zstd -dc part-*.txt`) and Spark's committer handles lost and repeated tasks. The text source
splits files at the separators, so one large file is read by many tasks.
"""

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

# Fixed value: an empty skippable frame, magic number 0x184D2A50 and size 0, little-endian.
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
# Text of one frame; a longer line has a frame of its own.
FRAME_BYTES = 1 << 20
LEVELS = range(3, 20)


def compressed(data):
    """One frame that does not hold the separator; in the rare case that it does, at another level."""
    for level in LEVELS:
        frame = pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)
        if EMPTY_FRAME.encode() not in frame:
            return frame
    raise ValueError("every frame of these lines holds the separator")


def frames_of(column):
    """Frames of the strings of an Arrow column; their bytes are cut, never turned into single values."""
    if not len(column):
        return
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + FRAME_BYTES, "right")) - 1)
        yield compressed(data[int(ends[start]) : int(ends[stop])])
        start = stop


def write_lines(lines, path, mode="overwrite"):
    """Write the one string column of `lines`, no nulls, a line per row."""
    (name,) = lines.columns

    def frames(batches):
        for batch in batches:
            for frame in frames_of(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], names=["frame"])

    ended = lines.select(F.concat(F.col(name), F.lit("\n")).alias("line"))
    packed = ended.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string"))
    packed.write.mode(mode).option("lineSep", EMPTY_FRAME).text(path)


def lines_of(batches):
    for batch in batches:
        for frame in batch.column(0):
            raw = pa.BufferReader(frame.as_buffer())
            with pa.CompressedInputStream(raw, "zstd") as data:
                text = io.TextIOWrapper(data, encoding="utf-8", newline="\n")
                while found := text.readlines(FRAME_BYTES):
                    lines = pc.utf8_rtrim(pa.array(found, pa.string()), "\r\n")
                    yield pa.RecordBatch.from_arrays([lines], names=["value"])


def read_lines(spark, path):
    """Lines (`value`) of the files of `write_lines` and of `.zst` files by other tools; blank lines are left out.

    Spark's text source has no decoder for `.zst`, so those are read whole, one file a row (up to 2 GB compressed).
    """
    own = spark.read.option("lineSep", EMPTY_FRAME).option("pathGlobFilter", "*.txt").text(path)
    own = own.select(F.col("value").cast("binary").alias("frame")).filter(F.octet_length("frame") > 0)
    other = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").load(path)
    frames = own.unionByName(other.select(F.col("content").alias("frame")).filter(F.octet_length("frame") > 0))
    return frames.mapInArrow(lines_of, "value string").filter(F.trim("value") != "")
