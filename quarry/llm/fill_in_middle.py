"""Fill-in-middle transformation: texts cut at two line ranks found in an indexable skip list.

A text's lines are the nodes of a skip list. Every lane is a thinned copy of the one below,
and every link carries its unit width (lines it passes) and its code-point width. A cut rank
is found by going down from the top lane, passing links while the accumulated unit width
stays within the rank; the accumulated code-point width is then the cut's exact place.

Cut ranks and form come from a hash of the seed and the document's id, so that a document is
cut alike in every run and every partition. Rows are independent: nothing is shuffled.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.llm.common import free_name
from quarry.llm.near_duplicates import mixed_numbers, plain_texts, text_slices

MARKERS = ("<P>", "<S>", "<M>")
# One node in four of a lane is also in the lane above; a lane of at most TOP nodes is the last.
LANE_BITS, TOP = 2, 4


class SkipList:
    """Lanes of (units, points, down): link widths, and each node's place in the lane below."""

    def __init__(self, points):
        """`points` holds the code-point width of every unit."""
        self.size = len(points)
        units, nodes = np.ones(len(points), np.int64), np.arange(len(points))
        heights = mixed_numbers(1, len(points))
        self.lanes = [(units, points, None)]
        while len(nodes) > TOP:
            heights = heights >> np.uint64(LANE_BITS)
            stays = (heights & np.uint64((1 << LANE_BITS) - 1)) == 0
            stays[0] = True
            down = np.flatnonzero(stays)
            units, points = np.add.reduceat(units, down), np.add.reduceat(points, down)
            nodes, heights = nodes[down], heights[down]
            self.lanes.append((units, points, down))
            if len(self.lanes) * LANE_BITS >= 60:
                break

    def place(self, rank):
        """Code points before the unit of that rank (0 to the number of units)."""
        if not 0 <= rank <= self.size:
            raise IndexError(rank)
        units_before = points_before = node = 0
        for units, points, down in reversed(self.lanes):
            while node < len(units) and units_before + units[node] <= rank:
                units_before += int(units[node])
                points_before += int(points[node])
                node += 1
            if units_before == rank:
                return points_before
            node = down[node]


def line_widths(text):
    """Code points of every line, its line feed included; what follows the last line feed is a line if not empty."""
    data = np.frombuffer(text.encode(), np.uint8)
    ends = np.flatnonzero(data == 10) + 1
    starts = np.concatenate([[0], ends])
    starts = starts[starts < len(data)]
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)


def cut_text(text, h1, h2, h3, h4, percent, spm_percent):
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    widths = line_widths(text)
    n = len(widths)
    if not text or any(m in text for m in MARKERS) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    lines = SkipList(widths)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = lines.place(low), lines.place(high)
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = MARKERS
    if h4 % 100 < spm_percent:
        return n, "spm", first, second - first, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", first, second - first, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs, seed=7, percent=100, spm_percent=50, doc_id="doc_id", text="text"):
    """The rows of `docs` with (n, form, output, prefix_chars, middle_chars).

    `n` is the number of lines, `output` the transformed text. `percent` of the documents are
    cut, `spm_percent` of those with the suffix first. A null text counts as empty; an empty
    text and a text that holds one of the markers are plain, and plain rows have null widths.
    A null id hashes like an empty one. Repeated rows are cut alike. Columns of the input
    that have the name of a result are replaced; all others stay. An empty table gives none.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    hashes = [free_name(docs, f"_h{k}") for k in range(4)]
    added = [("n", LongType()), ("form", StringType()), ("output", StringType()), ("prefix_chars", LongType()), ("middle_chars", LongType())]
    names = [name for name, _ in added]
    kept = docs.drop(*[c for c in docs.columns if c.lower() in names and c not in (doc_id, text)])
    hashed = kept.withColumns({c: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k, c in enumerate(hashes)})
    schema = StructType([*kept.schema.fields, *[StructField(name, kind) for name, kind in added]])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, column=text):
                h = [part.column(c).to_numpy() for c in hashes]
                texts = plain_texts(part, text)
                rows = [cut_text(t.as_py(), *(int(x[k]) for x in h), percent, spm_percent) for k, t in enumerate(texts)]
                n, form, prefix, middle, output = zip(*rows)
                columns = dict(zip(part.schema.names, part.columns)) | {
                    "n": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()), "output": pa.array(output, pa.string()),
                    "prefix_chars": pa.array(prefix, pa.int64()), "middle_chars": pa.array(middle, pa.int64()),
                }
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], names=schema.names)

    return hashed.mapInArrow(run, schema)


def restore(output, form):
    """The text that `output` was made of, a column: pieces stand between the first of each marker.

    The text holds no marker, and a marker can't overlap itself or another one, so the first
    occurrence is always the one that was put in.
    """
    p, s, m = MARKERS
    width = len(p)

    def pieces(second):
        """(what follows the first marker, what follows `second`, what follows the last)."""
        one = F.substring_index(output, second, 1)
        tail = F.substring(output, F.length(one) + width + 1, F.length(output))
        two = F.substring_index(tail, m, 1)
        return F.substring(one, F.lit(width + 1), F.length(one)), two, F.substring(tail, F.length(two) + width + 1, F.length(tail))

    prefix, suffix, middle = pieces(s)
    suffix_first, prefix_second, middle_last = pieces(p)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_second, middle_last, suffix_first))
        .otherwise(output)
    )


def fill_report(docs, **options):
    """Digest columns of `fill_in_middle`: (doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)."""
    cut = fill_in_middle(docs.select("doc_id", "text"), **options)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"), sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
