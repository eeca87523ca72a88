"""Packing of sequences into bins of fixed token capacity.

Only (shard, sequence id, length) reaches the packing step. `parts` is a declared property of
a packing: every shard is cut by a hash of the sequence id into that many parts, each packed
alone. It never depends on the number of rows; one part is fine for the first two algorithms.

- `first_fit_decreasing` depends on the histogram of lengths only. Bins with the same content
  form runs, and a run takes the sequences of one length at once, so a part's plan is made from
  at most `capacity` numbers. Every sequence then finds its bin from its rank among those of its
  length, by a join with the plan.
- `concatenative` (next-fit) is a walk whose state is the fill of the open bin. Blocks of the
  sequence order are read as functions of that state, all blocks at once; the chain of blocks
  gives every block its state at entry, and a second pass writes the bins.
- `first_fit_shuffle` is sequential by its definition: a part is packed in one task.
"""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window, functions as F

from quarry.plans.checkpoints import cut_lineage
from quarry.plans.prefix import position, range_buckets
from quarry.plans.skew import join_groups

BLOCK_ROWS = 1_000_000
PLAN = "array<struct<length:bigint,from:bigint,upto:bigint,first:bigint,each:bigint,pos:bigint>>"


def clamp(df, capacity, length="length"):
    """Clamp lengths to the capacity; `clamped` marks the changed rows."""
    return df.withColumns({"clamped": F.col(length) > capacity, length: F.least(length, F.lit(capacity))})


def first_fit(lengths, capacity):
    """Bin number per length. A max-tree over the room left finds the first bin
    with enough room in O(log bins)."""
    leaves = 1
    while leaves < max(len(lengths), 1):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins = []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        room[node] -= length
        node //= 2
        while node:
            room[node] = max(room[2 * node], room[2 * node + 1])
            node //= 2
    return bins


def part_of(seq, parts):
    """Part number of a sequence: 60 bits of its id's md5, modulo `parts`."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(seq).cast("string")), 1, 15), 16, 10).cast("bigint"), F.lit(parts)).cast("int")


def run_plan(lengths, counts, capacity):
    """First-fit decreasing over a histogram with falling lengths.

    Runs are groups of neighbouring bins with equal content: (count, room, filled). Returns
    (length, from, upto, first, each, pos): of the sequences of a length, those with ranks in
    [from, upto) lie in bins from `first` on, `each` in a bin, at places from `pos` on.
    """
    runs, plan = np.zeros((3, 0), np.int64), []
    for length, count in zip(lengths, counts):
        size, room, held = runs
        fits = room // length if length > 0 else np.where(size > 0, count, 0)
        takes = np.minimum(np.cumsum(fits * size), count)
        took, starts = np.diff(takes, prepend=0), np.cumsum(size) - size
        parts, done = [], 0
        for k in np.flatnonzero(took).tolist():
            each, got = int(fits[k]), int(took[k])
            plan.append((length, int(takes[k]) - got, int(takes[k]), int(starts[k]), each, int(held[k])))
            parts += [runs[:, done:k], split_run(size[k], room[k], held[k], length, got, each)]
            done = k + 1
        parts.append(runs[:, done:])
        left = count - (int(takes[-1]) if len(takes) else 0)
        if left:
            each = capacity // length if length > 0 else left
            plan.append((length, count - left, count, int(size.sum()), each, 0))
            parts.append(split_run(-(-left // each), capacity, 0, length, left, each))
        runs = np.concatenate(parts, axis=1)
    return plan


def split_run(size, room, held, length, got, each):
    """The runs that a run becomes when its bins take `got` sequences of one length, `each` per bin in order."""
    full, rest = divmod(got, each)
    columns = [(full, room - each * length, held + each), (int(rest > 0), room - rest * length, held + rest), (size - full - (rest > 0), room, held)]
    return np.array([c for c in columns if c[0]], np.int64).T


def histogram_plans(histogram, capacity, keys):
    """(keys, plan) for rows of (keys, h array<struct<length, n>>) with falling lengths: one small row per part."""

    def run(batches):
        for batch in batches:
            plans = []
            for entries in batch.column("h").to_pylist():
                found = run_plan([e["length"] for e in entries], [e["n"] for e in entries], capacity)
                plans.append([dict(zip(("length", "from", "upto", "first", "each", "pos"), p)) for p in found])
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("length", "from", "upto", "first", "each", "pos")]))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(plans, kind)], names=[*keys, "plan"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in histogram.schema if f.name in keys)
    return histogram.mapInArrow(run, f"{shape}, plan {PLAN}")


def pack_decreasing(cut, capacity, shard, seq, length):
    """First-fit decreasing of (shard, part, seq, length); ties in length go by `seq`."""
    keys = [shard, "part"]
    counts = cut_lineage(cut.groupBy(*keys, length).agg(F.count("*").alias("n")))
    lists = counts.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(length).cast("bigint").alias("length"), "n")), asc=False).alias("h")
    )
    plan = histogram_plans(lists, capacity, keys).select(*keys, F.explode("plan").alias("p"))
    ranges = plan.groupBy(*keys, F.col("p.length").alias("_length")).agg(F.collect_list("p").alias("ranges"))
    sized = counts.withColumnRenamed(length, "_length").join(
        ranges.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_length").alias("_of"), "ranges"),
        F.col(shard).eqNullSafe(F.col(f"_{shard}")) & (F.col("part") == F.col("_part")) & (F.col("_length") == F.col("_of")),
    )
    sized = sized.select(*keys, F.col("_length").alias(length), "n", "ranges")
    ranked = position(cut, seq, by=[*keys, length], out="_rank")
    joined = join_groups(ranked, cut_lineage(sized), [*keys, length], [seq])
    mine = F.filter("ranges", lambda r: (r["from"] <= F.col("_rank")) & (F.col("_rank") < r["upto"]))[0]
    placed = joined.withColumn("_at", mine).withColumn("_offset", F.col("_rank") - F.col("_at.from"))
    return placed.select(
        *keys, (F.col("_at.first") + F.floor(F.col("_offset") / F.col("_at.each"))).cast("bigint").alias("bin_id"),
        (F.col("_at.pos") + F.col("_offset") % F.col("_at.each")).alias("pos"), seq, length,
    )


def block_bins(lengths, capacity):
    """(sums, following): running sums, and the first sequence that opens a new bin after a bin that begins with i."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    return sums, np.searchsorted(sums[1:], sums[:-1] + capacity, side="right")


def block_exits(lengths, capacity):
    """A block as a function of the fill of the bin that is open before it: rows (most, opened, fill, items).

    A row holds for fills up to `most` and above the row before. `opened` bins are new; `fill`
    and `items` are those of the open bin at the end, to be added to those at entry if none is.
    """
    sums, following = block_bins(lengths, capacity)
    count = len(lengths)
    opened, last = [0] * (count + 1), list(range(count + 1))
    for i, after in zip(range(count - 1, -1, -1), following[::-1].tolist()):
        opened[i] = 1 + opened[after]
        last[i] = last[after] if after < count else i
    # With fill u the first new bin begins with the first i where u + sums[i + 1] > capacity.
    firsts = np.searchsorted(sums[1:], capacity - np.arange(capacity + 1), side="right")
    ends = np.flatnonzero(np.append(firsts[1:] != firsts[:-1], True))
    total = int(sums[-1])
    return [
        (int(u), opened[i], total - int(sums[last[i]]) if i < count else total, count - last[i] if i < count else count)
        for u, i in zip(ends, firsts[ends].tolist())
    ]


def chain_entries(blocks):
    """(block, bin, fill, items) at the entry of every block, from [(block, exits)] in order."""
    number = fill = items = 0
    out = []
    for block, exits in blocks:
        out.append((block, number, fill, items))
        opened, new_fill, new_items = next(e[1:] for e in exits if fill <= e[0])
        fill, items = (new_fill, new_items) if opened else (fill + new_fill, items + new_items)
        number += opened
    return out


def fill_block(lengths, capacity, number, fill, items):
    """(bin, pos) of a block's sequences, from the state at its entry."""
    sums, following = block_bins(lengths, capacity)
    count = len(lengths)
    begins = np.zeros(count, np.int64)
    at = int(np.searchsorted(sums[1:], capacity - fill, side="right"))
    while at < count:
        begins[at] = 1
        at = int(following[at])
    starts = np.flatnonzero(begins)
    own = np.cumsum(begins)
    places = np.arange(count)
    first = np.concatenate([[-items], starts])[own]
    return number + own, places - first


def pack_next_fit(cut, capacity, shard, seq, length):
    """Next-fit of (shard, part, seq, length) in the order of `seq`."""
    keys = [shard, "part"]
    blocks = range_buckets(cut, [*keys, seq], BLOCK_ROWS, "_block")
    shape = {f.name: f.dataType.simpleString() for f in blocks.schema}
    names = ", ".join(f"`{k}` {shape[k]}" for k in (*keys, "_block"))
    exit_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("most", "opened", "fill", "items")]))

    def in_order(table):
        return table.sort_by([(seq, "ascending")])

    def exits(table):
        found = block_exits(in_order(table)[length].to_numpy(), capacity)
        rows = [dict(zip(("most", "opened", "fill", "items"), e)) for e in found]
        return table.slice(0, 1).select([*keys, "_block"]).append_column("exits", pa.array([rows], exit_type))

    per_block = blocks.groupBy(*keys, "_block").applyInArrow(exits, f"{names}, exits array<struct<most:bigint,opened:bigint,fill:bigint,items:bigint>>")
    chains = per_block.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_block", "exits"))).alias("chain"))
    entry_type = pa.list_(pa.struct([("block", pa.int32()), ("number", pa.int64()), ("fill", pa.int64()), ("items", pa.int64())]))

    def entries(batches):
        for batch in batches:
            rows = []
            for chain in batch.column("chain").to_pylist():
                found = chain_entries([(b["_block"], [tuple(e.values()) for e in b["exits"]]) for b in chain])
                rows.append([dict(zip(("block", "number", "fill", "items"), e)) for e in found])
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(rows, entry_type)], names=[*keys, "entries"])

    key_names = ", ".join(f"`{k}` {shape[k]}" for k in keys)
    found = chains.mapInArrow(entries, f"{key_names}, entries array<struct<block:int,number:bigint,fill:bigint,items:bigint>>")
    states = cut_lineage(found.select(*keys, F.inline("entries")).withColumnRenamed("block", "_block"))

    def fill(rows, state):
        if not rows.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip(out_names, out_types)})
        rows = in_order(rows)
        bins, pos = fill_block(rows[length].to_numpy(), capacity, *(state[c][0].as_py() for c in ("number", "fill", "items")))
        return pa.table([rows[shard], rows["part"], pa.array(bins), pa.array(pos), rows[seq], rows[length]], names=out_names)

    out_names = [shard, "part", "bin_id", "pos", seq, length]
    out_types = [pa.int64()] * 6
    result = f"`{shard}` {shape[shard]}, part int, bin_id bigint, pos bigint, `{seq}` {shape[seq]}, `{length}` {shape[length]}"
    groups = [*keys, "_block"]
    return blocks.groupBy(*groups).cogroup(states.groupBy(*groups)).applyInArrow(fill, result)


def pack(
    df, capacity, algorithm="first_fit_shuffle", shard="shard", seq="seq_id", length="length", seed=42,
    parts=1,
):
    """(shard, part, bin_id, pos, seq, length): bins per shard, `pos` inside the bin.

    Sequence ids are unique inside a shard. A longer sequence counts with the capacity.
    """
    if capacity <= 0:
        raise ValueError(f"the capacity must be positive, not {capacity}")
    slim = clamp(df.select(shard, seq, length), capacity, length).drop("clamped")
    cut = slim.withColumn("part", part_of(seq, parts))
    if algorithm == "first_fit_decreasing":
        return pack_decreasing(cut_lineage(cut), capacity, shard, seq, length)
    if algorithm == "concatenative":
        return pack_next_fit(cut_lineage(cut), capacity, shard, seq, length)
    if algorithm != "first_fit_shuffle":
        raise ValueError(f"unknown packing algorithm: {algorithm}")
    kind = {name: t for name, t in df.dtypes}

    def one(frame):
        frame = frame.sort_values(seq, kind="stable").reset_index(drop=True)
        lengths = frame[length].tolist()
        order = list(range(len(lengths)))
        random.Random(seed).shuffle(order)
        out = frame.iloc[order].reset_index(drop=True)
        out["bin_id"] = pd.Series(first_fit([lengths[i] for i in order], capacity), dtype="int64")
        out["pos"] = out.groupby("bin_id").cumcount()
        return out[[shard, "part", "bin_id", "pos", seq, length]]

    shape = f"{shard} {kind[shard]}, part int, bin_id bigint, pos bigint, {seq} {kind[seq]}, {length} {kind[length]}"
    return cut.groupBy(shard, "part").applyInPandas(one, shape)


def align_mask(mask):
    """mask[j] := mask[j + 1], last = 0, so it speaks about the next token."""
    mask = F.col(mask) if isinstance(mask, str) else mask
    return F.when(F.size(mask) > 0, F.concat(F.slice(mask, 2, F.size(mask)), F.array(F.lit(0)))).otherwise(mask)


def unknown_sequences(sequences, assignment, keys=("shard", "seq_id")):
    """Assigned ids that do not exist; must be empty."""
    return assignment.join(sequences.select(*keys), list(keys), "left_anti")


def materialize_bins(sequences, assignment, capacity, shard="shard", seq="seq_id", ids="input_ids", mask="loss_mask"):
    """Concatenate sequences in bin order: input_ids, loss_mask, seq_start_id.

    Starts come from ids and sizes alone; the arrays are shuffled to their sequence and then to
    their bin, which holds at most `capacity` tokens.
    """
    keys = [shard, seq]
    size = F.least(F.size(ids), F.lit(capacity))
    sized = assignment.select(shard, "part", "bin_id", "pos", seq).join(sequences.select(*keys, size.alias("_size")), keys)
    before = (
        Window.partitionBy(shard, "part", "bin_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("_size").over(before), F.lit(0)).cast("int")
    placed = sized.withColumn("_start", start).withColumn("_room", F.lit(capacity) - F.col("_start"))
    fitting = placed.filter((F.col("_room") > 0) & (F.col("_size") > 0)).drop("_size")
    fitting = fitting.join(sequences.select(*keys, F.slice(ids, 1, capacity).alias("_ids"), F.slice(mask, 1, capacity).alias("_mask")), keys)
    entry = F.struct(
        "pos",
        F.col("_start").alias("start"),
        F.slice("_ids", F.lit(1), F.col("_room")).alias("ids"),
        align_mask(F.slice("_mask", F.lit(1), F.col("_room"))).alias("mask"),
    )
    rows = fitting.groupBy(shard, "part", "bin_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return rows.select(
        shard, "part", "bin_id",
        F.flatten("e.ids").alias("input_ids"),
        F.flatten("e.mask").cast("array<tinyint>").alias("loss_mask"),
        F.col("e.start").alias("seq_start_id"),
    )


def packing_metrics(assignment, capacity, by=(), length="length"):
    """Sequences per bin (2 decimals) and share of filled tokens in percent (1 decimal)."""
    bins = assignment.groupBy(*by, *[c for c in ("shard", "part") if c not in by], "bin_id").agg(
        F.count("*").alias("n"), F.sum(length).alias("t")
    )
    total = bins.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_sequences"),
        F.count("*").alias("num_bins"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("total_tokens"),
    )
    some = F.col("num_bins") > 0
    return total.withColumns(
        {
            "packing_factor": F.when(some, F.round(F.col("num_sequences") / F.col("num_bins"), 2)).otherwise(0.0),
            "packing_efficiency": F.when(
                some, F.round(F.col("total_tokens") / (F.col("num_bins") * capacity) * 100, 1)
            ).otherwise(0.0),
        }
    )


def pack_metadata(packed, capacity):
    """Summary fields of a packed data set (from materialised bins)."""
    n, size = F.size("seq_start_id"), F.size("input_ids")
    ends = F.concat(F.slice("seq_start_id", 2, F.greatest(n, F.lit(1))), F.array(size))
    longest = F.array_max(F.zip_with(ends, "seq_start_id", lambda e, s: e - s))
    return packed.agg(
        F.max(n).cast("bigint").alias("max_samples_per_bin"),
        F.max(longest).cast("bigint").alias("dataset_max_seqlen"),
        F.min(size).cast("bigint").alias("min_packed_seqlen"),
        F.round(F.avg(n), 2).alias("packing_factor"),
        F.round(F.sum(size) / (F.count("*") * capacity) * 100, 1).alias("packing_efficiency"),
        F.lit(capacity).cast("bigint").alias("pack_size"),
    )
