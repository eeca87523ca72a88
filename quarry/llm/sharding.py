"""Consistent placement of rows on shards with a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: slot `(offset + j * skip) mod slots` for j = 0, 1, ... Shards take turns in
list order, and each turn claims the shard's next free slot, until the table is
full. A row is placed by one look into the table at the hash of its key. All
shards get the same number of slots up to one, and adding or removing a shard
moves few rows between the others.

The table depends on the shard names only, never on rows. It is filled while the
plan is made, has `slots` entries (at most `MAX_SLOTS`, a fixed bound), and is
broadcast, so that placement is row-local: no shuffle, no Python on executors.
"""

import hashlib

from pyspark.sql import functions as F

SLOTS_PER_SHARD = 100
MAX_SLOTS = 1 << 20


def next_prime(n):
    """The smallest prime of at least `n`."""
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def fill_slots(shards, slots=None):
    """The shard number of every slot. `shards`: distinct names, in turn order."""
    shards = [str(s) for s in shards]
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct names, at least one")
    slots = slots or next_prime(SLOTS_PER_SHARD * len(shards))
    if slots != next_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from {len(shards)} to {MAX_SLOTS}")
    digests = [hashlib.md5(s.encode()).hexdigest() for s in shards]
    place = [int(d[:15], 16) % slots for d in digests]
    skip = [int(d[15:30], 16) % max(slots - 1, 1) + 1 for d in digests]
    owner = [None] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[place[shard]] is not None:
            place[shard] = (place[shard] + skip[shard]) % slots
        owner[place[shard]] = shard
    return owner


def slot_of(key, slots):
    """Slot of a key: 60 bits of its MD5, modulo the table size. Null is hashed as ''."""
    text = F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def slot_table(spark, shards, slots=None):
    """The filled table as a DataFrame (slot int, shard int, shard_name string)."""
    owner = fill_slots(shards, slots)
    names = F.split(F.lit("\x1f".join(str(s) for s in shards)), "\x1f")
    numbers = F.split(F.lit(",".join(map(str, owner))), ",")
    return spark.range(1).select(F.posexplode(numbers).alias("slot", "shard")).select(
        "slot", F.col("shard").cast("int").alias("shard"), F.get(names, F.col("shard").cast("int")).alias("shard_name")
    )


def assign_shards(df, key, shards, slots=None, out="shard"):
    """Add the shard number of every row of `df`; all rows are kept.

    `shards` is a number of shards or a list of names. Equal keys share a shard;
    rows with a null key go where the empty text goes. An empty table stays empty.
    An input column named `out` is replaced; other columns are untouched.
    """
    names = [f"shard-{i}" for i in range(shards)] if isinstance(shards, int) else list(shards)
    table = slot_table(df.sparkSession, names, slots)
    size = slots or next_prime(SLOTS_PER_SHARD * len(names))
    joined = df.join(F.broadcast(table), slot_of(df[key], size) == table["slot"])
    return joined.select(*[df[c] for c in df.columns if c != out], table["shard"].alias(out))


def shard_report(df, key, shards, slots=None):
    """(shard, rows, slots): load of every shard, from one map-side combined count."""
    names = [f"shard-{i}" for i in range(shards)] if isinstance(shards, int) else list(shards)
    rows = assign_shards(df, key, names, slots).groupBy("shard").agg(F.count("*").alias("rows"))
    owned = slot_table(df.sparkSession, names, slots).groupBy("shard").agg(F.count("*").alias("slots"))
    return owned.join(rows, "shard", "left").select("shard", F.coalesce("rows", F.lit(0)).alias("rows"), "slots")
