"""`format("tokenidx")`: token sequences as a `.bin` / `.idx` pair per partition, written and read back."""

import os
import struct
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

# File magic, version, codes of the number types and the layout of the header.
MAGIC = b"MMIDIDX\x00\x00"
VERSION = 1
TYPE_CODES = {"int32": 4, "int64": 5, "uint16": 8}
HEADER = "<9sQBQQ"

# Token ids that a reading task hands on in one Arrow batch.
BATCH_TOKENS = 1 << 20


def filesystem(path):
    """(file system, path inside it) for a local path or a file-system URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def index_bytes(lengths, dtype):
    """Content of an `.idx` file for sequences of the given lengths."""
    import numpy as np

    sizes = np.asarray(lengths, dtype=np.int64)
    ends = np.cumsum(sizes * np.dtype(dtype).itemsize)
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(sizes) else ends
    # One document per sequence; the list of borders starts at 0.
    borders = np.arange(len(sizes) + 1, dtype=np.int64)
    head = struct.pack(HEADER, MAGIC, VERSION, TYPE_CODES[dtype], len(sizes), len(borders))
    return head + sizes.astype(np.int32).tobytes() + starts.tobytes() + borders.tobytes()


def parse_index(data, bin_bytes):
    """(dtype, sizes, pointers, borders) of an `.idx` file, checked against the size of its `.bin` file."""
    import numpy as np

    head = struct.calcsize(HEADER)
    if len(data) < head:
        raise ValueError("the index is shorter than its header")
    magic, version, code, count, n_borders = struct.unpack(HEADER, data[:head])
    dtype = {c: name for name, c in TYPE_CODES.items()}.get(code)
    if magic != MAGIC or version != VERSION or dtype is None:
        raise ValueError("this is no index of a known version and number type")
    if len(data) != head + 12 * count + 8 * n_borders:
        raise ValueError("the index is not as long as its counts say")
    sizes = np.frombuffer(data, np.int32, count, head)
    starts = np.frombuffer(data, np.int64, count, head + 4 * count)
    borders = np.frombuffer(data, np.int64, n_borders, head + 12 * count)
    ends = starts + sizes.astype(np.int64) * np.dtype(dtype).itemsize
    if count and (sizes.min() < 0 or starts.min() < 0 or ends.max() > bin_bytes):
        raise ValueError("a sequence lies outside of the data file")
    if not n_borders or borders[0] != 0 or borders[-1] != count or (np.diff(borders) < 0).any():
        raise ValueError("the document borders do not run from 0 to the number of sequences")
    return dtype, sizes, starts, borders


@dataclass
class Written(WriterCommitMessage):
    name: str


class TokenIndexWriter(DataSourceArrowWriter):
    """Options: `dtype` (int32, int64, uint16) and `column` (default input_ids).

    A task writes a hidden pair; the driver shows the pairs of the tasks that Spark committed, the data file
    before its index. On overwrite, old pairs go only after all new ones can be seen, and `_SUCCESS` is
    absent in between: readers refuse a folder without it.
    """

    def __init__(self, options, schema, overwrite):
        self.path, self.options, self.schema, self.overwrite = options["path"], dict(options), schema, overwrite

    def write(self, batches):
        import numpy as np
        from pyspark import TaskContext

        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        dtype, column = self.options.get("dtype", "int32"), self.options.get("column", "input_ids")
        name = f"shard_{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        lengths, limit = [np.zeros(0, np.int64)], np.iinfo(dtype).max
        with store.open_output_stream(f"{root}/.{name}.bin", compression=None) as out:
            for batch in batches:
                lists = batch.column(batch.schema.get_field_index(column))
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                if len(ids) and not 0 <= ids.min() <= ids.max() <= limit:
                    raise ValueError(f"token ids from {ids.min()} to {ids.max()} do not fit into {dtype}")
                out.write(ids.astype(dtype).tobytes())
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                lengths.append(sizes[sizes > 0])
        with store.open_output_stream(f"{root}/.{name}.idx", compression=None) as out:
            out.write(index_bytes(np.concatenate(lengths), dtype))
        return Written(name)

    def commit(self, messages):
        from pyarrow import fs

        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        there = [f for f in store.get_file_info(fs.FileSelector(root)) if f.is_file]
        for old in there:
            if old.base_name == "_SUCCESS":
                store.delete_file(old.path)
        for done in messages:
            if done is not None:
                for ending in ("bin", "idx"):
                    store.move(f"{root}/.{done.name}.{ending}", f"{root}/{done.name}.{ending}")
        for old in there:
            if self.overwrite and not old.base_name.startswith((".", "_")):
                store.delete_file(old.path)
        with store.open_output_stream(f"{root}/_SUCCESS") as marker:
            marker.write(b"")

    def abort(self, messages):
        store, root = filesystem(self.path)
        for done in messages:
            if done is not None:
                for ending in ("bin", "idx"):
                    store.delete_file(f"{root}/.{done.name}.{ending}")


@dataclass
class Pair(InputPartition):
    stem: str


class TokenIndexReader(DataSourceReader):
    """One partition per pair. The index is read whole, the data file by the pointers, a batch at a time."""

    def __init__(self, path):
        self.path = path

    def partitions(self):
        from pyarrow import fs

        store, root = filesystem(self.path)
        names = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.is_file and not f.base_name.startswith(".")]
        if f"{root.rstrip('/')}/_SUCCESS" not in names:
            raise ValueError(f"no finished token index in {self.path}")
        return [Pair(p.removesuffix(".idx")) for p in sorted(names) if p.endswith(".idx")]

    def read(self, partition):
        import numpy as np
        import pyarrow as pa

        store, _ = filesystem(self.path)
        with store.open_input_stream(f"{partition.stem}.idx", compression=None) as index:
            content = index.read()
        with store.open_input_file(f"{partition.stem}.bin") as data:
            dtype, sizes, starts, borders = parse_index(content, data.size())
            # The document of a sequence is the last one that begins at or before it.
            documents = np.searchsorted(borders, np.arange(len(sizes)), "right") - 1
            # Sequences of one batch: by the running number of ids before them.
            before = np.cumsum(sizes, dtype=np.int64) - sizes
            cuts = np.flatnonzero(np.diff(before // BATCH_TOKENS)) + 1
            for rows in np.split(np.arange(len(sizes)), cuts):
                if not len(rows):
                    continue
                pieces = [
                    np.frombuffer(data.read_at(int(sizes[i]) * np.dtype(dtype).itemsize, int(starts[i])), dtype) for i in rows
                ]
                ends = np.concatenate([[0], np.cumsum(sizes[rows])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(pieces).astype(np.int64)))
                name = os.path.basename(partition.stem)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows)), pa.array(documents[rows].astype(np.int64)), ids],
                    names=["file", "document", "input_ids"],
                )


class TokenIndex(DataSource):
    @classmethod
    def name(cls):
        return "tokenidx"

    def schema(self):
        return "file string, document bigint, input_ids array<bigint>"

    def reader(self, schema):
        return TokenIndexReader(self.options["path"])

    def writer(self, schema, overwrite):
        return TokenIndexWriter(self.options, schema, overwrite)
