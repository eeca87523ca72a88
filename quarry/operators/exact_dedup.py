"""Exact duplicates by text hash, and removal of listed ids."""

from pyspark.sql import functions as F


def kept_ids(df, text="text", id="doc_id"):
    """The smallest id per distinct text. The hash groups are combined map-side,
    so a text that fills a third of the corpus still sends one row per task."""
    return df.groupBy(F.md5(text).alias("_h")).agg(F.min(id).alias(id)).select(id)


def exact_duplicates(df, text="text", id="doc_id"):
    """Ids of every copy but the first. Joined on the id, which is not skewed."""
    return df.select(id).join(kept_ids(df, text, id), id, "left_anti")


def remove_ids(df, ids, id="doc_id", fields=None):
    """Drop the listed ids and keep the listed output fields."""
    left = df.join(ids.select(id), id, "left_anti")
    return left.select(*fields) if fields else left


def exact_dedup(df, text="text", id="doc_id", fields=None):
    left = df.join(kept_ids(df, text, id), id, "left_semi")
    return left.select(*fields) if fields else left


def dedup_report(df, duplicates):
    """Rows read, duplicates found, rows left."""
    read = df.agg(F.count("*").alias("n"))
    found = duplicates.agg(F.count("*").alias("n"))
    return read.select(
        F.col("n").alias("input_rows"),
        found.scalar().alias("duplicates"),
        (F.col("n") - found.scalar()).alias("rows_left"),
    )


def distinct_sources(df, keys, order):
    """Distinct sources by key, each with its first position."""
    return df.groupBy(*keys).agg(F.min(order).alias("first_seen"))
