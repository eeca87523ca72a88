"""Sinks (written, then read back), incremental runs and user functions."""

import uuid

from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, heavy, table, token_count_sql
from quarry.catalog.chat import PACKED, digest, digest_sql, packed
from quarry.catalog.curation import BINS, BUCKET, SCORES, scored, scored_sql
from quarry.catalog.tokens import IDS, coded
from quarry.functions.columns import token_count
from quarry.operators import custom, quality, sharding, tokens
from quarry.plans.checkpoints import shared_folder
from quarry.sources import readers, writers
from quarry.streaming import incremental as inc

CATALOG = Catalog()


def folder_for(spark):
    """A new folder below the shared folder."""
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


@CATALOG.add("jsonl_round_trip", "SELECT conv_id, turn, role, text FROM conversations")
def _(spark, folder):
    path = folder_for(spark)
    df = table(spark, folder, "conversations")
    writers.write_jsonl(df, path)
    return readers.read_jsonl(spark, path, df.schema)


@CATALOG.add("jsonl_counts", "SELECT count(*) FILTER (role <> 'system') AS written, count(*) FILTER (role = 'system') AS skipped FROM conversations")
def _(spark, folder):
    counts = writers.write_jsonl(
        table(spark, folder, "conversations"), folder_for(spark), skip=F.col("role") == "system"
    )
    return spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()])


@CATALOG.add("jsonl_zstd_round_trip", "SELECT conv_id, turn, role, text FROM conversations")
def _(spark, folder):
    path = folder_for(spark)
    df = table(spark, folder, "conversations")
    writers.write_jsonl(df, path, compression="zstd")
    return writers.read_jsonl_zstd(spark, path, df.schema)


@CATALOG.add("parquet_round_trip", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, folder):
    path = folder_for(spark)
    writers.write_parquet(table(spark, folder, "orders"), path)
    return readers.read_auto(spark, path).select("o_orderkey", "o_totalprice")


@CATALOG.add("read_auto_mixed", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer")
def _(spark, folder):
    base = folder_for(spark)
    df = table(spark, folder, "customer").select("c_custkey", "c_name")
    writers.write_jsonl(df, f"{base}/a.jsonl")
    writers.write_parquet(df, f"{base}/b.parquet")
    return readers.read_auto(spark, [f"{base}/a.jsonl", f"{base}/b.parquet"])


@CATALOG.add(
    "read_quality_buckets",
    f'WITH {scored_sql()}, {BINS} SELECT doc_id, {BUCKET} AS bucket FROM bins WHERE {BUCKET} IN (18, 19)',
)
def _(spark, folder):
    """Bucketed write, then a read that prunes to buckets 18 and 19."""
    path = folder_for(spark)
    out = quality.ensemble_buckets(scored(spark, folder), SCORES, store=False)
    writers.write_bucketed(out, path)
    return readers.read_buckets(spark, path, [18, 19]).select(
        "doc_id", F.col("`ensemble-max-int`").cast("bigint").alias("bucket")
    )


@CATALOG.add(
    "packed_round_trip",
    f"WITH RECURSIVE {PACKED} SELECT n, starts, ids_md5, mask_md5 FROM full_bins",
)
def _(spark, folder):
    """The bins read back from the packed files, whole."""
    path = folder_for(spark)
    writers.write_packed(packed(spark, folder), path, "zstd", pack_size=512)
    arrays = spark.read.parquet(path)
    return arrays.select(
        F.size("input_ids").cast("bigint").alias("n"), F.array_join(F.col("seq_start_id").cast("array<string>"), ",").alias("starts"),
        digest("input_ids").alias("ids_md5"), digest("loss_mask").alias("mask_md5"),
    )


@CATALOG.add(
    "token_index_files",
    f"SELECT count(*) AS sequences, sum({token_count_sql()} + 1)::BIGINT AS tokens FROM documents",
)
def _(spark, folder):
    """Sequences from the index headers and tokens from the data sizes of the written pairs."""
    path = folder_for(spark)
    docs = tokens.add_special(tokens.tokenize(heavy(spark, folder)))
    writers.write_token_index(docs, path)
    files = lambda ending: spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ending}").load(path)
    # The count is an eight-byte little-endian number behind magic, version and type.
    digits = F.hex(F.substring("content", 19, 8))
    number = F.conv(F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)]), 16, 10).cast("bigint")
    sizes = files("bin").agg((F.sum("length") / 4).cast("bigint").alias("t"))
    return files("idx").agg(F.sum(number).alias("sequences")).select("sequences", sizes.scalar().alias("tokens"))


@CATALOG.add(
    "token_index_round_trip",
    f"SELECT len(ids) AS n, {digest_sql('ids')} AS ids_md5 FROM (SELECT {IDS} AS ids FROM documents) WHERE len(ids) > 0",
)
def _(spark, folder):
    """All ids of every written sequence, found again by the pointers of the index."""
    path = folder_for(spark)
    writers.write_token_index(coded(spark, folder), path)
    found = writers.read_token_index(spark, path)
    return found.select(F.size("input_ids").cast("bigint").alias("n"), digest("input_ids").alias("ids_md5"))


@CATALOG.add(
    "write_splits",
    "WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY md5('42:' || p_partkey), p_partkey) AS r FROM part)"
    " SELECT p_partkey, CASE WHEN r <= 20 THEN 'test' WHEN r <= 50 THEN 'valid' ELSE 'train' END AS split FROM r",
)
def _(spark, folder):
    path = folder_for(spark)
    writers.write_splits(sharding.shard_splits(table(spark, folder, "part").select("p_partkey"), 30, 20, 42, "p_partkey"), path)
    return spark.read.parquet(f"{path}/splits").select("p_partkey", "split")


@CATALOG.add(
    "manifest_file",
    "SELECT lang AS split, count(DISTINCT source) AS n FROM documents GROUP BY 1",
)
def _(spark, folder):
    path = folder_for(spark)
    shards = table(spark, folder, "documents").select(
        F.col("lang").alias("split"), F.lit(1.0).alias("weight"), F.col("source").alias("path")
    ).distinct()
    writers.write_blend_manifest(shards, path)
    read = spark.read.text(path).select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("split", "e"))
    return read.select("split", (F.size("e") / 2).cast("bigint").alias("n"))


@CATALOG.add("csv_round_trip", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(spark, folder):
    path = folder_for(spark) + "/predictions.csv"
    writers.write_csv(table(spark, folder, "supplier"), path)
    return readers.read_table(spark, path).select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name", "s_acctbal")


@CATALOG.add(
    "sorted_jsonl",
    f"SELECT conv_id, turn, text, {token_count_sql()} AS length FROM conversations",
)
def _(spark, folder):
    """ASCII JSON lines in length order, parsed back."""
    path = folder_for(spark)
    df = table(spark, folder, "conversations").select("conv_id", "turn", "text", token_count("text").alias("length"))
    writers.write_sorted_jsonl(df, path)
    lines = spark.read.text(path).filter(~F.col("value").rlike("[^\\x00-\\x7f]"))
    return lines.select(F.from_json("value", df.schema).alias("r")).select("r.*")


@CATALOG.add("incremental_events", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE value > 1 GROUP BY event_type")
def _(spark, folder):
    """Two runs over the same files: the second one adds nothing."""
    base = folder_for(spark)
    source = table(spark, folder, "events")
    writers.write_parquet(source, f"{base}/in")
    for _ in range(2):
        inc.incremental(spark, f"{base}/in", f"{base}/out", lambda d: d.filter("value > 1"), f"{base}/state", source.schema)
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@CATALOG.add(
    "incremental_stats",
    f"SELECT count(*) AS rows_in, count(*) FILTER (length(text) >= 100) AS rows_out, count(*) FILTER (length(text) < 100) AS filtered,"
    f" (sum({token_count_sql()}) FILTER (length(text) >= 100))::BIGINT AS tokens FROM conversations",
)
def _(spark, folder):
    base = folder_for(spark)
    source = table(spark, folder, "conversations")
    writers.write_parquet(source.repartition(4, "conv_id"), f"{base}/in")
    inc.incremental_stats(
        spark, f"{base}/in", f"{base}/out", f"{base}/stats",
        lambda d: d.withColumn("kept", F.char_length("text") >= 100),
        f"{base}/state", source.schema, tokens=token_count("text"), files_per_batch=2,
    )
    names = ["rows_in", "rows_out", "filtered", "tokens"]
    return spark.read.parquet(f"{base}/stats").agg(*[F.sum(c).alias(c) for c in names])


@CATALOG.add("score_modify", "SELECT doc_id, lower(text) AS text, strlen(text) AS bytes FROM documents WHERE strlen(text) > 300")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored_docs = custom.score_filter(docs, F.octet_length, "bytes", lambda c: c > 300)
    return custom.modify(scored_docs, F.lower)


WEIGHTED = """SELECT l_returnflag, count(*) AS n, round(sum(w * x) / sum(w), 9) AS mean,
      round(sum(w * x * x) / sum(w) - (sum(w * x) / sum(w)) * (sum(w * x) / sum(w)), 9) AS variance
    FROM (SELECT l_returnflag, l_discount::DOUBLE AS x, l_quantity::DOUBLE AS w FROM lineitem) GROUP BY l_returnflag"""


def weighted_lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_discount").cast("double").alias("x"), F.col("l_quantity").cast("double").alias("w")
    )


@CATALOG.add("user_aggregate", WEIGHTED)
def _(spark, folder):
    out = custom.aggregate(weighted_lines(spark, folder), custom.weighted_moments("x", "w"), ["l_returnflag"])
    variance = F.round(F.col("squares") / F.col("weight"), 9).alias("variance")
    return out.select("l_returnflag", "n", F.round("mean", 9).alias("mean"), variance)


@CATALOG.add("user_aggregate_sql", WEIGHTED)
def _(spark, folder):
    """The registered form: slices of a group first, then their states."""
    custom.register_aggregate(spark, "moments", custom.weighted_moments("x", "w"))
    table(spark, folder, "lineitem").createOrReplaceTempView("moment_lines")
    return spark.sql(
        """WITH slices AS (
          SELECT l_returnflag, moments_partial(CAST(l_discount AS DOUBLE), CAST(l_quantity AS DOUBLE)) AS state
          FROM moment_lines GROUP BY l_returnflag, pmod(hash(l_orderkey), 64)),
        merged AS (
          SELECT l_returnflag, from_json(moments_merge(state), 'array<double>') AS s FROM slices GROUP BY l_returnflag)
        SELECT l_returnflag, CAST(s[0] AS BIGINT) AS n, round(s[2], 9) AS mean, round(s[3] / s[1], 9) AS variance FROM merged"""
    )


@CATALOG.add("block_stage", "SELECT o_orderkey, upper(o_orderpriority) AS priority FROM orders")
def _(spark, folder):
    def stage(block):
        block["priority"] = block["o_orderpriority"].str.upper()
        return block[["o_orderkey", "priority"]] if len(block) else None

    return custom.block_stage(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), stage, "o_orderkey long, priority string")


@CATALOG.add(
    "split_lines_function",
    "SELECT item_id, count(*) AS n FROM (SELECT item_id, unnest(string_split(text, chr(10))) FROM benchmark) GROUP BY item_id",
)
def _(spark, folder):
    custom.register_table_functions(spark)
    table(spark, folder, "benchmark").createOrReplaceTempView("benchmark_lines")
    return spark.sql(
        "SELECT item_id, count(*) AS n FROM benchmark_lines, LATERAL split_lines(text) GROUP BY item_id"
    )
