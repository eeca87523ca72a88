"""Table writers."""

from pyspark.sql import Observation, functions as F

from quarry.operators.blend import blend_manifest
from quarry.sources import jsonl_zstd
from quarry.sources.tokenidx import TokenIndex


def write_jsonl(df, path, compression=None, skip=None, mode="overwrite"):
    """JSON lines in UTF-8. Returns {"written": n, "skipped": n}, counted while writing.

    `skip` is a condition for rows to leave out. `compression="zstd"` compresses in Arrow
    batches (`jsonl_zstd`); gzip and the like are Spark's own.
    """
    condition = F.lit(False) if skip is None else F.coalesce(skip, F.lit(False))
    seen = Observation()
    watched = df.withColumn("_skip", condition).observe(
        seen, F.count_if(~F.col("_skip")).alias("written"), F.count_if("_skip").alias("skipped")
    )
    kept = watched.filter(~F.col("_skip")).drop("_skip")
    if compression == "zstd":
        jsonl_zstd.write_lines(kept.select(F.to_json(F.struct(*kept.columns)).alias("value")), path, mode)
    else:
        writer = kept.write.mode(mode)
        (writer.option("compression", compression) if compression else writer).json(path)
    return {k: int(v) for k, v in seen.get.items()}


def read_jsonl_zstd(spark, path, schema=None):
    """Lines (`value`), or parsed records when a schema is given."""
    lines = jsonl_zstd.read_lines(spark, path)
    return lines if schema is None else lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_parquet(df, path, mode="overwrite"):
    df.write.mode(mode).parquet(path)


def write_bucketed(df, path, column="ensemble-max-int"):
    """One folder per bucket. Rows are rebalanced by bucket: adaptive execution cuts a large
    bucket into as many tasks as its size asks for and joins small ones."""
    df.hint("rebalance", F.col(f"`{column}`")).write.mode("overwrite").partitionBy(column).parquet(path)


def write_packed(df, path, compression="zstd", rows_per_file=100_000, rows_per_group=1000, pack_size=4096):
    """Packed bins with a fixed schema. The Parquet block size is set to the bytes of
    about `rows_per_group` full bins."""
    fixed = df.select(
        F.col("input_ids").cast("array<int>"), F.col("loss_mask").cast("array<tinyint>"), F.col("seq_start_id").cast("array<int>")
    )
    codec = {"none": "uncompressed"}.get(compression, compression)
    (
        fixed.write.mode("overwrite")
        .option("compression", codec)
        .option("maxRecordsPerFile", rows_per_file)
        .option("parquet.block.size", rows_per_group * pack_size * 8)
        .parquet(path)
    )


def write_token_index(df, path, dtype="int32", column="input_ids"):
    """`.bin` / `.idx` pair per partition; empty sequences are left out."""
    df.sparkSession.dataSource.register(TokenIndex)
    kept = df.select(column).filter(F.size(column) > 0)
    kept.write.format("tokenidx").option("dtype", dtype).option("column", column).mode("overwrite").save(path)


def read_token_index(spark, path, column="input_ids"):
    """The sequences of the pairs in a folder, found by the pointers of their index, a task per pair:
    (file, document, column). Index files whose counts, sizes, pointers or borders disagree are an error."""
    spark.dataSource.register(TokenIndex)
    found = spark.read.format("tokenidx").option("path", path).load()
    return found.withColumnRenamed("input_ids", column)


def write_splits(df, path, split="split", folder="splits"):
    """Folders `splits/split=train|valid|test`; an empty train split is an error.

    The rows are counted while they are written.
    """
    seen = Observation()
    watched = df.observe(seen, F.count_if(F.col(split) == "train").alias("train"))
    watched.write.mode("overwrite").partitionBy(split).parquet(f"{path}/{folder}")
    if not seen.get["train"]:
        raise ValueError("the train split is empty")


def write_blend_manifest(shards, path, **columns):
    """One JSON record: split -> [weight, path, weight, path, ...]."""
    rows = blend_manifest(shards, **columns)
    entries = F.map_from_entries(F.collect_list(F.struct("split", "entries")))
    rows.agg(F.to_json(entries).alias("value")).write.mode("overwrite").text(path)


def write_csv(df, path):
    df.write.mode("overwrite").option("header", True).csv(path)


def ascii_json(columns):
    """One JSON text per row with every non-ASCII character escaped (UTF-16 units)."""
    units = F.hex(F.encode(F.to_json(F.struct(*columns)), "UTF-16BE"))
    chars = F.regexp_extract_all(units, F.lit("(.{4})"), F.lit(1))

    def one(u):
        code = F.conv(u, 16, 10).cast("int")
        return F.when(code < 128, F.char(code)).otherwise(F.concat(F.lit("\\u"), F.lower(u)))

    return F.array_join(F.transform(chars, one), "")


def write_sorted_jsonl(df, path, by="length"):
    """JSON lines in order of a column, ASCII only."""
    df.orderBy(by).select(ascii_json(df.columns).alias("value")).write.mode("overwrite").text(path)
