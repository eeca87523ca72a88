"""Helpers shared by the operators of this folder."""

import uuid

from pyspark.sql import functions as F

from quarry.plans.checkpoints import cut_lineage, drop_stored, shared_folder

# A key is hot from this many rows on; at most MOST_HOT keys are ever treated as hot,
# because the limit rises with the total. So the broadcast of hot keys stays small.
LEAST_HOT = 500
MOST_HOT = 10_000

# Words of the ASCII-lowercased text, per contract.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text):
    return F.translate(text, UPPER, LOWER)


def free_name(df, name):
    """`name`, with underscores added until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def new_folder(spark, name):
    """A new folder below the cluster's shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df):
    """`df` written to the shared folder and read back: computed once, survives lost executors."""
    return cut_lineage(df)


def attach(members, groups, keys, spread, size="n"):
    """Left join of `members` with the one row of `groups` for their keys, balanced for hot keys.

    `groups` is a stored table with one row per key and the key's number of members in
    `size`. The members of a hot key are cut into slices by a hash of `spread`, and the
    key's row is repeated per slice. Null keys find nothing. `groups` adds its other columns.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot_rows = max(LEAST_HOT, total // MOST_HOT)
    slices = F.ceil(F.col(size) / F.lit(hot_rows)).cast("int")
    hot = groups.filter(F.col(size) > hot_rows)
    hot = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], slices.alias("_slices"))
    is_hot, match = F.lit(True), F.col("_slice") == F.col("_copy")
    for k in keys:
        is_hot = is_hot & (F.col(k) == F.col(f"_hot_{k}"))
        match = match & (F.col(k) == F.col(f"_group_{k}"))
    slot = F.pmod(F.xxhash64(*spread), F.col("_slices")).cast("int")
    marked = members.join(F.broadcast(hot), is_hot, "left").withColumn("_slice", F.coalesce(slot, F.lit(0)))
    marked = marked.drop("_slices", *[f"_hot_{k}" for k in keys])
    copies = groups.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1))).drop(size)
    copies = copies.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    return marked.join(copies, match, "left").drop("_slice", "_copy", *[f"_group_{k}" for k in keys])


BROADCAST_BYTES = 128 << 20


def row_bytes(df):
    """About how many bytes a row takes, a column."""
    total = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = F.octet_length(c)
        elif kind == "array<string>":
            size = F.octet_length(F.array_join(c, "        "))
        elif kind.startswith("array"):
            size = F.size(c) * 8 * max(1, kind.count(":"))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size.cast("bigint"), F.lit(0))
    return total


def broadcast_up_to(df, rows):
    """`df` marked for broadcast if it has at most `rows` rows and `BROADCAST_BYTES` bytes (both counted), else as it is."""
    found = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= rows and found["bytes"] <= BROADCAST_BYTES else df


class Scratch:
    """Stored tables that an operator needs for a while only; `clear` deletes them."""

    def __init__(self):
        self.tables = []

    def keep(self, df):
        table = stored(df)
        self.tables.append(table)
        return table

    def clear(self):
        while self.tables:
            drop_stored(self.tables.pop())
