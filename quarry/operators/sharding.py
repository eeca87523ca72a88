"""Shard assignment, samples, splits and source fingerprints."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.plans.checkpoints import cut_lineage
from quarry.plans.prefix import hash_rank, position
from quarry.plans.skew import join_groups

# Hex digits of the path hash that name a part of a listing.
PREFIX_DIGITS = 3
# Entries (files times shards) that a task compares at once.
LEVEL_CELLS = 1 << 22


def picks_below(loads, size, level):
    """How many files of `size` the lightest-shard rule deals at loads below each level."""
    return np.maximum(-((loads[None, :] - level[:, None]) // size), 0).sum(axis=1)


def level_of(loads, size, rank):
    """The load of the shard that takes the file of each rank, among files of one size.

    A shard that starts at load l takes files at l, l + size, l + 2 * size, ...; the rule takes
    these steps of all shards in order. So the level is the largest load with at most `rank` steps below it.
    """
    low = np.full(len(rank), loads.min())
    high = loads.max() + size * (rank // len(loads) + 1)
    while (low < high).any():
        middle = low + (high - low + 1) // 2
        fits = picks_below(loads, size, middle) <= rank
        low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
    return low


def shards_of(loads, size, rank):
    """The shard of the file of each rank (0-based), for files of one size; ties go to the lowest shard."""
    if size == 0:
        return np.full(len(rank), loads.argmin(), np.int32)
    chosen, step = np.empty(len(rank), np.int32), max(1, LEVEL_CELLS // len(loads))
    for i in range(0, len(rank), step):
        part = rank[i : i + step]
        level = level_of(loads, size, part)
        gap = level[:, None] - loads[None, :]
        at = (gap >= 0) & (gap % size == 0)
        place = part - picks_below(loads, size, level) + 1
        chosen[i : i + step] = (np.cumsum(at, axis=1) == place[:, None]).argmax(axis=1)
    return chosen


def loads_after(loads, size, count):
    """The loads when `count` files of one size are dealt."""
    if size == 0:
        return loads
    level = level_of(loads, size, np.array([count]))
    gap = level - loads
    taken = np.maximum(-(-gap // size), 0)
    rest = count - taken.sum()
    at = np.flatnonzero((gap >= 0) & (gap % size == 0))[:rest]
    taken[at] += 1
    return loads + taken * size


def balanced_shards(df, shards, key="path", size="size", by="dataset"):
    """Lightest-shard assignment of files: size descending, then path; ties go to
    the lowest shard. When no file of a data set has a size: round robin.

    Files of one size are a class. Only the classes of a data set are dealt one after the other, by their
    counts: one load per shard is the state, one row per distinct size the result. Every file then finds its
    shard from the loads before its class and its rank inside it, in any task. A size that is null or below 0 counts as 0.
    """
    weight = F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0))
    slim = df.select(by, key, size)
    slim = cut_lineage(slim.withColumn("_class", weight).withColumn("_missing", F.col(size).isNull().cast("int")))
    classes = slim.groupBy(by, "_class").agg(F.count("*").alias("n"))

    def deal(batches):
        current, loads = object(), None
        for batch in batches:
            before = []
            for dataset, weight, n in zip(*[batch.column(c).to_pylist() for c in (by, "_class", "n")]):
                if dataset != current:
                    # The largest class comes first: without a size nothing has one.
                    current, loads = dataset, np.zeros(shards, np.int64) if weight > 0 else None
                before.append(loads)
                if loads is not None:
                    loads = loads_after(loads, weight, n)
            columns = [*batch.columns, pa.array(before, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_loads"])

    shape = ", ".join(f"`{name}` {kind}" for name, kind in classes.dtypes)
    ordered = classes.repartition(by).sortWithinPartitions(by, F.desc("_class"))
    plan = cut_lineage(ordered.mapInArrow(deal, f"{shape}, _loads array<bigint>"))

    @F.pandas_udf("int")
    def shard_of(dataset: pd.Series, weight: pd.Series, rank: pd.Series, loads: pd.Series) -> pd.Series:
        out = pd.Series(0, index=rank.index, dtype="int32")
        for (_, size), rows in rank.groupby([dataset, weight], dropna=False):
            before = loads.loc[rows.index[0]]
            ranks = rows.to_numpy(np.int64)
            chosen = ranks % shards if before is None else shards_of(np.asarray(before, np.int64), int(size), ranks)
            out.loc[rows.index] = chosen.astype(np.int32)
        return out

    ranked = position(slim, "_missing", by=[by, "_class"], ties=[key], out="_rank")
    placed = join_groups(ranked, plan, [by, "_class"], [key, "_rank"])
    return placed.select(by, key, size, shard_of(by, "_class", "_rank", "_loads").alias("shard"))


def round_robin(df, shards, order, by=()):
    """Position modulo the number of shards."""
    placed = position(df, order, by=by, out="_position")
    return placed.withColumn("shard", (F.col("_position") % shards).cast("int")).drop("_position")


def sample_shards(df, spec, seed, dataset="dataset", shard="shard"):
    """Per data set a seeded sample of shards: "10%" (at least one) or a count."""
    named = df.withColumn("_name", F.concat_ws(":", dataset, F.col(shard).cast("string")))
    ranked = hash_rank(named, "_name", seed, by=[dataset], out="_rank")
    if isinstance(spec, str) and spec.endswith("%"):
        sizes = df.groupBy(dataset).agg(F.count("*").alias("_n"))
        take = F.greatest(F.lit(1), F.floor(F.col("_n") * (float(spec[:-1]) / 100)))
        ranked = ranked.join(sizes, dataset).filter(F.col("_rank") <= take).drop("_n")
    else:
        ranked = ranked.filter(F.col("_rank") <= int(spec))
    return ranked.drop("_rank", "_name")


def shard_splits(df, valid, test, seed, key="path"):
    """Seeded shuffle over the pool of all shards: first test, then valid, rest train.
    Requests beyond the pool are capped."""
    ranked = hash_rank(df, key, seed, out="_rank")
    split = (
        F.when(F.col("_rank") <= test, "test")
        .when(F.col("_rank") <= test + valid, "valid")
        .otherwise("train")
    )
    return ranked.withColumn("split", split).drop("_rank")


def ratio_splits(df, valid, test, seed, key="path"):
    """`shard_splits` with shares of the pool instead of counts.

    A share above 0 asks for the rounded number of shards, but for one at least. Training
    keeps one shard: if the two ask for more than the others, they shrink in proportion. A
    pool of up to two shards is all training.
    """
    ranked = hash_rank(df, key, seed, out="_rank")
    pool = df.agg(F.count("*").alias("n")).scalar()
    asked = {name: F.greatest(F.lit(1), F.bround(F.col("_pool") * share)) if share > 0 else F.lit(0.0) for name, share in (("_v", valid), ("_t", test))}
    sized = ranked.withColumn("_pool", pool).withColumns(asked)
    spare = F.col("_pool") - 1
    shrink = F.least(F.lit(1.0), spare / F.greatest(F.col("_v") + F.col("_t"), F.lit(1)))
    # A tiny amount keeps whole numbers whole after the division.
    last_test = F.floor(F.col("_t") * shrink + 1e-9)
    last_valid = last_test + F.floor(F.col("_v") * shrink + 1e-9)
    split = (
        F.when(F.col("_pool") <= 2, "train").when(F.col("_rank") <= last_test, "test").when(F.col("_rank") <= last_valid, "valid").otherwise("train")
    )
    return sized.withColumn("split", split).drop("_rank", "_pool", "_v", "_t")


def fraction_split(df, val, test, seed, key):
    """Seeded row split: floor(n * fraction) rows each to val and test, rest train."""
    ranked = hash_rank(df, key, seed, out="_rank")
    n = df.agg(F.count("*").alias("n")).scalar()
    n_val, n_test = F.floor(n * F.lit(val)), F.floor(n * F.lit(test))
    counted = ranked.withColumns({"_val": n_val, "_test": n_test})
    split = (
        F.when(F.col("_rank") <= F.col("_val"), "validation")
        .when(F.col("_rank") <= F.col("_val") + F.col("_test"), "test")
        .otherwise("training")
    )
    return counted.withColumn("split", split).drop("_rank", "_val", "_test")


def holdout_split(df, n, order, max_rows=None):
    """Last n rows in order to `val`, the rest to `train`; with n rows or fewer all
    go to train. `order` must be unique.

    The border is the n-th largest key: a top-n, not a sort of the whole table.
    """
    if max_rows is not None:
        df = df.orderBy(order).limit(max_rows)
    total = df.agg(F.count("*").alias("n")).scalar()
    border = df.select(order).orderBy(F.desc(order)).limit(n).agg(F.min(order).alias("b")).scalar()
    marked = df.withColumns({"_total": total, "_border": border})
    split = F.when((F.col("_total") > n) & (F.col(order) >= F.col("_border")), "val").otherwise("train")
    return marked.withColumn("split", split).drop("_total", "_border")


def split_name(column):
    """`validation` is called `val`."""
    return F.when(F.col(column) == "validation", "val").otherwise(F.col(column))


def fingerprint(inventory, by="dataset", path="path", parts=("size", "etag"), digits=PREFIX_DIGITS):
    """sha256 over the listing of each data set, a function of that data set alone.

    The `path:size:etag` lines are grouped by the first hex digits of the path's md5; every
    group has a digest of its sorted lines, and the sorted `prefix:digest` lines are digested
    again. So a task holds a share of a listing or at most 16 ** digits digests, whatever the
    size. `parts` may name further columns, such as a modification time or a version.
    """
    line = F.concat_ws(":", F.col(path), *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    lines = inventory.select(by, line.alias("_line"), F.substring(F.md5(path), 1, digits).alias("_prefix"))
    digest = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "\n"), 256)
    groups = lines.groupBy(by, "_prefix").agg(digest("_line").alias("_digest"))
    named = groups.withColumn("_entry", F.concat_ws(":", "_prefix", "_digest"))
    return named.groupBy(by).agg(F.concat(F.lit("sha256:"), digest("_entry")).alias("fingerprint"))
