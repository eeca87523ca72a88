"""Blends of named sources, shares, sampling and run statistics."""

from functools import reduce

from pyspark.sql import functions as F

from quarry.plans.prefix import hash_rank
from quarry.sources.readers import read_auto

SPLITS = ("train", "valid", "test")


def blend_sources(spec):
    """Flat list of sources from a spec with either `datasets` or train/valid/test lists."""
    single, split = bool(spec.get("datasets")), any(spec.get(s) for s in SPLITS)
    if single == split:
        raise ValueError("a blend needs either datasets or train/valid/test lists")
    if single:
        return [dict(source) for source in spec["datasets"]]
    return [dict(source, blend_split=s) for s in SPLITS for source in spec.get(s) or []]


def blend(spark, spec, load=None):
    """Union of all sources: dataset, weight, split, text."""
    frames = []
    for source in blend_sources(spec):
        df = load(source) if load else read_auto(spark, source["path"])
        frames.append(
            df.select(
                F.lit(source["name"]).alias("dataset"),
                F.lit(float(source.get("weight", 1.0))).alias("weight"),
                F.lit(source.get("blend_split")).cast("string").alias("split"),
                F.col(source.get("text_field", "text")).alias("text"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), frames)


def blend_shares(sources, weight="weight", tokens="tokens"):
    """Weights normalised to 1 and each source's share of all tokens.

    Rows are sources; the two totals are scalars.
    """
    totals = sources.agg(F.sum(weight).alias("w"), F.sum(tokens).alias("t"))
    return sources.withColumns(
        {
            "share": F.col(weight) / totals.select("w").scalar(),
            "token_share": F.col(tokens) / totals.select("t").scalar(),
        }
    )


def sample_blend(df, sources, target, key, seed=42, dataset="dataset", weight="weight", tokens=None):
    """Draw about `target` rows, each source by its normalised weight.

    With `tokens`, a column of token counts, `target` counts tokens: rows are drawn in order
    of their rank until the source's share is reached. A source that is too small is repeated;
    `copy` numbers the repetitions. A row whose predecessors sum up to `before` is drawn
    ceil((want - before) / size of the source) times.
    """
    amount = F.col(tokens).cast("bigint") if tokens else F.lit(1).cast("bigint")
    measured = df.withColumn("_amount", amount)
    sizes = measured.groupBy(dataset).agg(F.sum("_amount").alias("_n"))
    total = sources.agg(F.sum(weight).alias("w")).scalar()
    wanted = sources.select(dataset, F.round(F.col(weight) / total * target).cast("bigint").alias("_want"))
    ranked = hash_rank(measured, key, seed, by=[dataset], out="_upto", value="_amount")
    joined = ranked.join(wanted.join(sizes, dataset), dataset)
    before = F.col("_upto") - F.col("_amount")
    copies = F.ceil((F.col("_want") - before) / F.col("_n")).cast("int")
    drawn = joined.withColumn("_copies", copies).filter(F.col("_copies") > 0)
    return drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop(
        "_upto", "_amount", "_n", "_want", "_copies"
    )


def run_stats(df, by="dataset", shard="shard", length="length", bytes="bytes"):
    """Per data set and in total (dataset null): shards, sequences, tokens, bytes."""
    per_shard = df.groupBy(by, shard).agg(
        F.count("*").alias("s"), F.sum(length).alias("t"), F.sum(bytes).alias("b")
    )
    return per_shard.rollup(by).agg(
        F.count("*").alias("num_shards"),
        F.sum("s").alias("num_sequences"),
        F.sum("t").alias("total_tokens"),
        F.sum("b").alias("total_bytes"),
    )


def lineage(stats, sources, by="dataset"):
    """Statistics joined to the source list (uri, weight, split)."""
    return sources.join(stats, by, "left")


def split_tokens(df, split="split", length="length"):
    return df.groupBy(split).agg(F.count("*").alias("num_sequences"), F.sum(length).alias("total_tokens"))


def progress(df, by, started, done):
    """Counts, percent (1 decimal) and status per group."""
    counted = df.groupBy(by).agg(
        F.count("*").alias("total"), F.count_if(started).alias("started"), F.count_if(done).alias("completed")
    )
    status = (
        F.when(F.col("completed") == F.col("total"), "completed")
        .when(F.col("started") > 0, "in_progress")
        .otherwise("pending")
    )
    return counted.withColumns(
        {"percent": F.round(F.col("completed") / F.col("total") * 100, 1), "status": status}
    )


def metric_summary(df, metrics, by=()):
    """(metric, mean, std, sum) in one pass."""
    long = df.select(
        *by, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("m")
    )
    return long.groupBy(*by, F.col("m.metric").alias("metric")).agg(
        F.avg("m.v").alias("mean"), F.stddev("m.v").alias("std"), F.sum("m.v").alias("sum")
    )


def blend_manifest(shards, split="split", weight="weight", path="path"):
    """(split, entries): flat [weight, path, weight, path, ...] text list, weight 0 left out.

    Rows are shard paths, one entry per output file.
    """
    kept = shards.filter(F.col(weight) > 0)
    pair = F.struct(F.col(path).alias("p"), F.col(weight).cast("string").alias("w"))
    rows = kept.groupBy(split).agg(F.array_sort(F.collect_list(pair)).alias("e"))
    flat = F.flatten(F.transform("e", lambda x: F.array(x["w"], x["p"])))
    return rows.select(split, flat.alias("entries"))


