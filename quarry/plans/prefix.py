"""Running sums and ranks over a whole table without a one-task window.

A window ordered over a whole table (or over one huge group) runs in one task.
Here the order is first cut into buckets, each bucket is summed with a map-side
combine, and the short table of bucket totals gives every bucket its starting
offset. The ordered window then runs inside (group, bucket) only.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window, functions as F

from quarry.plans.checkpoints import cut_lineage


def quantile_bucket(df, column, buckets=1000, out="_bucket"):
    """Add an order-preserving bucket number with about equal rows per bucket.

    `column` must be numeric or a timestamp without nulls. The bounds come from
    one approximate-quantile pass; at most `buckets` numbers reach the driver.
    """
    if dict(df.dtypes)[column].startswith("timestamp"):
        number = F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    else:
        number = F.col(column).cast("double")
    numbered = df.withColumn("_order_number", number)
    steps = [i / buckets for i in range(1, buckets)]
    found = numbered.approxQuantile("_order_number", steps, 1 / (4 * buckets))
    bounds = [float("-inf"), *sorted(set(found)), float("inf")]
    if len(bounds) == 2:
        return df.withColumn(out, F.lit(0.0))
    cut = Bucketizer(splits=bounds, inputCol="_order_number", outputCol=out)
    return cut.transform(numbered).drop("_order_number")


def running_totals(df, values, order, bucket="_bucket", by=()):
    """Inclusive running sums in `order`, per `by`, inside buckets.

    `values`: output name -> column to sum. `bucket` is a column that never
    decreases along `order`. Ties in `order` need a tie-break column for a stable
    result. `df` is read twice (bucket totals, rows), so store it if it is costly.
    """
    by = list(by)
    keys = [*by, bucket]
    per_bucket = df.groupBy(*keys).agg(*[F.sum(v).alias(f"_total_{out}") for out, v in values.items()])
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *[F.col(c).alias(f"_key_{c}") for c in keys],
        *[F.coalesce(F.sum(f"_total_{out}").over(before), F.lit(0)).alias(f"_offset_{out}") for out in values],
    )
    inside = (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    match = F.lit(True)
    for c in keys:
        match = match & df[c].eqNullSafe(offsets[f"_key_{c}"])
    sums = {out: F.col(f"_offset_{out}") + F.sum(v).over(inside) for out, v in values.items()}
    joined = df.join(offsets, match).withColumns(sums)
    return joined.drop(*[f"_offset_{out}" for out in values], *[f"_key_{c}" for c in keys])


def running_total(df, value, order, bucket="_bucket", by=(), out="running"):
    return running_totals(df, {out: value}, order, bucket, by)


def first_reaching(sums, by, value, weight, wanted):
    """(by, name, value): the smallest value at which the running weight reaches a mark.

    `sums` has one row per (by, value); `wanted` maps a name to a function of the running
    and the total weight, false up to the mark and true from it on. Buckets of values are
    totalled first; only the bucket in which a mark lies is ranked.
    """
    sums = cut_lineage(sums.filter(F.col(value).isNotNull()))
    buckets = min(max(1000, sums.count() // 1_000_000), 20_000)
    cut = quantile_bucket(sums, value, buckets)
    per_bucket = cut.groupBy(by, "_bucket").agg(F.sum(weight).alias("_w"))
    in_group = Window.partitionBy(by)
    so_far = F.sum("_w").over(in_group.orderBy("_bucket"))
    ranked = per_bucket.withColumns({"_to": so_far, "_total": F.sum("_w").over(in_group)})
    place = F.struct("_bucket", (F.col("_to") - F.col("_w")).alias("_before"), "_total")
    firsts = [F.min(F.when(reached(F.col("_to"), F.col("_total")), place)).alias(str(name)) for name, reached in wanted.items()]
    rows = F.array(*[F.struct(F.lit(str(name)).alias("_name"), F.col(f"`{name}`").alias("_at")) for name in wanted])
    targets = ranked.groupBy(by).agg(*firsts).select(F.col(by).alias("_by"), F.explode(rows).alias("_t")).select("_by", "_t._name", "_t._at.*")
    targets = targets.withColumnRenamed("_bucket", "_target")
    inside = cut.join(targets, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_bucket") == F.col("_target")))
    upto = Window.partitionBy(by, "_name").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.col("_before") + F.sum(weight).over(upto)
    marks = None
    for name, reached in wanted.items():
        here = (F.col("_name") == str(name)) & reached(F.col("_running"), F.col("_total"))
        marks = here if marks is None else marks | here
    hit = inside.withColumn("_running", running).filter(marks)
    return hit.groupBy(by, F.col("_name").alias("name")).agg(F.min(value).alias("value"))


def range_buckets(df, order, rows=1_000_000, out="_bucket", buckets=0):
    """`df` stored in ranges of the order columns, at least `buckets`, with the range's number in `out`.

    Borders are tuples of all order columns, sampled by Spark, so rows that tie in the first
    column are cut by the next; with a unique last column no range holds many more than `rows`
    rows. Their number grows with the table. Any orderable type will do, nulls come first.
    """
    spark = df.sparkSession
    parts = max(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))
    return cut_lineage(df.repartitionByRange(parts, *order).withColumn(out, F.spark_partition_id()))


def position(df, order, by=(), ties=(), rows=1_000_000, out="position", buckets=0):
    """0-based position by a column of any orderable type, then by `ties`, per `by`.

    The order is cut into ranges of about `rows` rows, at least `buckets` (default: the shuffle
    partitions). Rows that tie in all of them get positions in any order. `df` is read three times
    (count, borders, rows), so store it if it is costly.
    """
    cut = range_buckets(df.withColumn("_one", F.lit(1).cast("bigint")), [*by, order, *ties], rows, buckets=buckets)
    ranked = running_total(cut, "_one", [order, *ties], by=by, out=out)
    return ranked.withColumn(out, F.col(out) - 1).drop("_one", "_bucket")


def hash_rank(df, key, seed, by=(), digits=3, out="rank", value=None):
    """1-based rank by md5(seed:key), ties by key: a seeded, repeatable shuffle.

    The first hex digits of the hash are the buckets, so they are of equal size
    whatever the data looks like (16**digits of them per group). With `value`, the
    running sum of that column in the same order.
    """
    text = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    cut = (
        df.withColumn("_hash", text)
        .withColumn("_bucket", F.substring("_hash", 1, digits))
        .withColumn("_one", F.col(value) if value else F.lit(1).cast("bigint"))
    )
    ranked = running_total(cut, "_one", ["_hash", key], by=by, out=out)
    return ranked.drop("_one", "_bucket", "_hash")
