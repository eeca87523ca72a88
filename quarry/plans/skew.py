"""Many-to-one join that stays balanced when one key holds most of the rows."""

from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
# So many keys at most are sliced: a key that isn't among them has fewer than total rows / MOST_HOT.
MOST_HOT = 10_000


def join_groups(members, groups, keys, spread, size="n", hot_rows=HOT_ROWS, null_keys=True):
    """Join every row of `members` with the one row of `groups` for its keys.

    `groups` comes from a `groupBy(keys)` and carries the group's row count in
    `size`. With `null_keys`, null matches null; switch it off where keys are never
    null. A group of more than `hot_rows` rows is cut
    into slices of about that many rows by a hash of `spread` (columns that differ
    between rows), so no task receives more than about `hot_rows` rows of one key.
    The table of hot keys is broadcast: it holds the `MOST_HOT` largest groups at most.
    """
    keys = list(keys)

    def equal(left, right):
        return F.col(left).eqNullSafe(F.col(right)) if null_keys else F.col(left) == F.col(right)

    hot = groups.filter(F.col(size) > hot_rows).orderBy(F.desc(size), *keys).limit(MOST_HOT)
    slices = F.ceil(F.col(size) / F.lit(hot_rows)).cast("int").alias("_slices")
    hot = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], slices)
    same = F.lit(True)
    for k in keys:
        same = same & equal(k, f"_hot_{k}")
    sliced = groups.join(F.broadcast(hot), same, "left").drop(*[f"_hot_{k}" for k in keys])
    sliced = sliced.withColumn("_slices", F.coalesce("_slices", F.lit(1)))
    slot = F.pmod(F.xxhash64(*spread), F.col("_slices")).cast("int")
    marked = members.join(F.broadcast(hot), same, "left").withColumn("_slice", F.coalesce(slot, F.lit(0)))
    marked = marked.drop("_slices", *[f"_hot_{k}" for k in keys])
    copies = sliced.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices")
    copies = copies.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    match = F.col("_slice") == F.col("_copy")
    for k in keys:
        match = match & equal(k, f"_group_{k}")
    return marked.join(copies, match).drop("_slice", "_copy", *[f"_group_{k}" for k in keys])
