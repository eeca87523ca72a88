"""Table readers. Paths may be any Hadoop file-system URI."""

import re

from pyspark.sql import functions as F

DATA_ENDINGS = (".parquet", ".jsonl", ".json")


def read_jsonl(spark, path, schema=None, mode="FAILFAST"):
    """One JSON record per non-blank line; a bad line fails the job by default."""
    reader = spark.read.option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark, path, columns=None):
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark, path):
    """CSV with a header, or Parquet, by the file ending."""
    if path.lower().endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.parquet(path)


def read_auto(spark, paths):
    """Mixed inputs: `.jsonl` / `.json` as JSON lines, everything else as Parquet."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    json_paths = [p for p in paths if p.lower().endswith((".jsonl", ".json"))]
    other = [p for p in paths if p not in json_paths]
    frames = []
    if json_paths:
        frames.append(read_jsonl(spark, json_paths))
    if other:
        frames.append(spark.read.parquet(*other))
    df = frames[0]
    for frame in frames[1:]:
        df = df.unionByName(frame, allowMissingColumns=True)
    return df


def file_inventory(spark, path):
    """Data files under a folder or glob, in all its subfolders, sorted by path: path, size, modification time."""
    ending = F.lower(F.col("path"))
    keep = F.lit(False)
    for suffix in DATA_ENDINGS:
        keep = keep | ending.endswith(suffix)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    return listed.filter(keep).orderBy("path")


def files_for_split(inventory, split, path="path"):
    """Keep files whose path has the split name as a proper component."""
    return inventory.filter(F.col(path).rlike(rf"(^|/){re.escape(split)}(-|/|\.|$)"))


def files_for_subset(inventory, subset, path="path"):
    """Keep files of a subset: folder, file-name prefix, or the whole stem."""
    p, name = F.col(path), re.escape(subset)
    folder_or_prefix = p.rlike(rf"(^|/){name}[/_-]")
    stem = p.rlike(rf"(^|/){name}(\.[^/.]*)?$") | p.contains(f"/{subset}.")
    return inventory.filter(folder_or_prefix | stem)


def spread(df, key):
    """Hash-partition a scan that has fewer splits than the session has cores.

    For CPU-heavy row work on inputs of few, large row groups. A scan that fills
    the cluster is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_buckets(spark, path, buckets, column="ensemble-max-int"):
    """Read quality buckets only; the filter prunes partition folders."""
    return spark.read.parquet(path).filter(F.col(f"`{column}`").isin(*buckets))
