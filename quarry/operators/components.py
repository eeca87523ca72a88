"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import functions as F

from quarry.plans.checkpoints import cut_lineage, drop_stored
from quarry.plans.skew import HOT_ROWS, join_groups


def _with_minimum(pairs, hot_rows):
    """(u, v, m): m is the smallest of u and all its neighbours v."""
    lowest = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    lowest = lowest.withColumn("m", F.least("u", "m"))
    return join_groups(pairs, lowest, ["u"], ["v"], hot_rows=hot_rows, null_keys=False)


def _large_star(edges, hot_rows):
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_minimum(both, hot_rows).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges, hot_rows):
    linked = _with_minimum(edges, hot_rows)
    ends = F.explode(F.array("v", "u")).alias("u")
    return linked.select("m", ends).filter("u <> m").select("u", F.col("m").alias("v")).distinct()


def _mark(edges):
    """Count and order-free checksum of an edge table."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges, src="src", dst="dst", max_rounds=60, hot_rows=HOT_ROWS):
    """(node, component) for every node with an edge; component = smallest node.

    Edges run from the larger to the smaller node. Each round is written to the
    checkpoint folder, so a lost executor repeats one round only; the round before it is deleted. Only a count
    and a checksum per round reach the driver.
    """
    edges = cut_lineage(
        edges.filter(F.col(src) != F.col(dst))
        .select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .distinct()
    )
    before = _mark(edges)
    for _ in range(max_rounds):
        last, edges = edges, cut_lineage(_small_star(_large_star(edges, hot_rows), hot_rows))
        drop_stored(last)
        after = _mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centers = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(centers)
