"""Shards, splits, blends and run statistics."""

from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, table, token_count_sql
from quarry.functions.columns import token_count
from quarry.operators import blend, sharding

CATALOG = Catalog()


def rank_sql(seed, key, by=""):
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY md5('{seed}:' || {key}), {key})"


def files(spark, folder):
    """The sources of each language as files: path = source, size = its bytes."""
    return table(spark, folder, "documents").groupBy(F.col("lang").alias("dataset"), F.col("source").alias("path")).agg(
        F.sum(F.octet_length("text")).alias("size")
    )


@CATALOG.add(
    "balanced_shards",
    """WITH RECURSIVE f AS (SELECT lang AS dataset, source AS path, sum(strlen(text))::BIGINT AS size FROM documents GROUP BY ALL),
    o AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY size DESC, path) AS i FROM f),
    walk(dataset, path, size, i, shard, loads) AS (
      SELECT dataset, path, size, i, 0::BIGINT, list_prepend(size, [0, 0, 0, 0, 0, 0, 0]::BIGINT[]) FROM o WHERE i = 1
      UNION ALL
      SELECT dataset, path, size, i, b - 1, list_transform(loads, lambda l, k: CASE WHEN k = b THEN l + size ELSE l END)
      FROM (SELECT o.dataset, o.path, o.size, o.i, w.loads, list_position(w.loads, list_min(w.loads)) AS b
            FROM walk w JOIN o ON o.dataset = w.dataset AND o.i = w.i + 1))
    SELECT dataset, path, size, shard::INTEGER AS shard FROM walk""",
)
def _(spark, folder):
    return sharding.balanced_shards(files(spark, folder), 8)


@CATALOG.add(
    "balanced_shards_without_sizes",
    "SELECT lang AS dataset, source AS path, 0::BIGINT AS size,"
    " ((row_number() OVER (PARTITION BY lang ORDER BY source) - 1) % 8)::INTEGER AS shard FROM documents GROUP BY lang, source",
)
def _(spark, folder):
    return sharding.balanced_shards(files(spark, folder).withColumn("size", F.lit(0).cast("bigint")), 8)


@CATALOG.add(
    "round_robin_shards",
    "SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) % 16)::INTEGER AS shard FROM orders",
)
def _(spark, folder):
    return sharding.round_robin(table(spark, folder, "orders").select("o_orderkey"), 16, "o_orderkey")


@CATALOG.add(
    "sample_shards_percent",
    f"""WITH s AS (SELECT c_mktsegment AS dataset, c_custkey AS shard, c_mktsegment || ':' || c_custkey AS k FROM customer),
    r AS (SELECT *, {rank_sql(42, "k", "dataset")} AS r, count(*) OVER (PARTITION BY dataset) AS n FROM s)
    SELECT dataset, shard FROM r WHERE r <= greatest(1, floor(n * 0.1::DOUBLE))""",
)
def _(spark, folder):
    shards = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("dataset"), F.col("c_custkey").alias("shard"))
    return sharding.sample_shards(shards, "10%", 42)


@CATALOG.add(
    "sample_shards_count",
    f"""WITH s AS (SELECT c_mktsegment AS dataset, c_custkey AS shard, c_mktsegment || ':' || c_custkey AS k FROM customer)
    SELECT dataset, shard FROM s QUALIFY {rank_sql(7, "k", "dataset")} <= 12""",
)
def _(spark, folder):
    shards = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("dataset"), F.col("c_custkey").alias("shard"))
    return sharding.sample_shards(shards, 12, 7)


SPLIT = f"""
sh AS (SELECT DISTINCT source AS dataset, source || '/shard_' || (doc_id % 16) AS path FROM documents),
sp AS (SELECT path, dataset, {rank_sql(42, "path")} AS r FROM sh),
named AS (SELECT path, dataset, CASE WHEN r <= 20 THEN 'test' WHEN r <= 50 THEN 'valid' ELSE 'train' END AS split FROM sp)"""


def split_shards(spark, folder):
    shards = table(spark, folder, "documents").select(
        F.col("source").alias("dataset"), F.concat("source", F.lit("/shard_"), F.col("doc_id") % 16).alias("path")
    ).distinct()
    return sharding.shard_splits(shards, valid=30, test=20, seed=42)


@CATALOG.add("shard_splits", f"WITH {SPLIT} SELECT path, dataset, split FROM named")
def _(spark, folder):
    return split_shards(spark, folder)


@CATALOG.add(
    "ratio_splits",
    f"""WITH s AS (SELECT source AS dataset, source || '/shard_' || (doc_id % 16) AS path FROM documents GROUP BY ALL),
    r AS (SELECT *, {rank_sql(7, "path")} AS r, count(*) OVER () AS n FROM s)
    SELECT path, dataset, CASE WHEN n <= 2 THEN 'train' WHEN r <= greatest(1, round_even(n * 0.02::DOUBLE, 0)) THEN 'test'
      WHEN r <= greatest(1, round_even(n * 0.02::DOUBLE, 0)) + greatest(1, round_even(n * 0.1::DOUBLE, 0)) THEN 'valid' ELSE 'train' END AS split FROM r""",
)
def _(spark, folder):
    shards = table(spark, folder, "documents").select(
        F.col("source").alias("dataset"), F.concat("source", F.lit("/shard_"), F.col("doc_id") % 16).alias("path")
    ).distinct()
    return sharding.ratio_splits(shards, 0.1, 0.02, 7)


@CATALOG.add(
    "blend_manifest",
    f"""WITH {SPLIT}, w AS (SELECT split, path, CASE WHEN dataset = 'src1' THEN 0 ELSE 1.5 END AS weight FROM named)
    SELECT split, string_agg('1.5,' || path, ',' ORDER BY path) AS entries FROM w WHERE weight > 0 GROUP BY split""",
)
def _(spark, folder):
    shards = split_shards(spark, folder).select(
        "split", "path",
        F.when(F.col("dataset") == "src1", 0.0).otherwise(1.5).alias("weight"),
    )
    return blend.blend_manifest(shards).select("split", F.array_join("entries", ",").alias("entries"))


@CATALOG.add(
    "fraction_split",
    f"""WITH r AS (SELECT o_orderkey, {rank_sql(186, "o_orderkey")} AS r, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, CASE WHEN r <= floor(n * 0.05::DOUBLE) THEN 'validation'
      WHEN r <= floor(n * 0.05::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'test' ELSE 'training' END AS split FROM r""",
)
def _(spark, folder):
    return sharding.fraction_split(table(spark, folder, "orders").select("o_orderkey"), 0.05, 0.1, 186, "o_orderkey")


@CATALOG.add(
    "holdout_split",
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS r, count(*) OVER () AS n FROM documents)
    SELECT doc_id, CASE WHEN n > 100 AND r <= 100 THEN 'val' ELSE 'train' END AS split FROM r""",
)
def _(spark, folder):
    return sharding.holdout_split(table(spark, folder, "documents").select("doc_id"), 100, "doc_id")


LINES = """
l AS (SELECT source, doc_id || ':' || n_chars || ':' || md5(text) AS line, substr(md5(doc_id::VARCHAR), 1, 3) AS p FROM documents),
g AS (SELECT source, p || ':' || sha256(string_agg(line, chr(10) ORDER BY line)) AS entry FROM l GROUP BY source, p)"""


@CATALOG.add(
    "source_fingerprint",
    f"WITH {LINES} SELECT source, 'sha256:' || sha256(string_agg(entry, chr(10) ORDER BY entry)) AS fingerprint FROM g GROUP BY source",
)
def _(spark, folder):
    """Documents as files: path = id, size = characters, etag = content hash."""
    inventory = table(spark, folder, "documents").select(
        "source", F.col("doc_id").cast("string").alias("path"), F.col("n_chars").alias("size"), F.md5("text").alias("etag")
    )
    return sharding.fingerprint(inventory, by="source")


@CATALOG.add(
    "source_fingerprint_parts",
    f"""WITH {LINES.replace("|| md5(text) AS line", "|| md5(text) || ':' || lang AS line")}
    SELECT source, 'sha256:' || sha256(string_agg(entry, chr(10) ORDER BY entry)) AS fingerprint FROM g GROUP BY source""",
)
def _(spark, folder):
    """A further identity part per file; here the language stands for a version."""
    inventory = table(spark, folder, "documents").select(
        "source", F.col("doc_id").cast("string").alias("path"), F.col("n_chars").alias("size"), F.md5("text").alias("etag"), F.col("lang").alias("version")
    )
    return sharding.fingerprint(inventory, by="source", parts=("size", "etag", "version"))


# --- blends ------------------------------------------------------------------

SPEC = {
    "datasets": [
        {"name": "parts", "path": "part", "weight": 1.0, "text_field": "p_name"},
        {"name": "suppliers", "path": "supplier", "weight": 0.5, "text_field": "s_name"},
        {"name": "customers", "path": "customer", "weight": 2.5, "text_field": "c_name"},
    ]
}


@CATALOG.add(
    "blend_sources",
    """SELECT 'parts' AS dataset, 1.0::DOUBLE AS weight, NULL AS split, p_name AS text FROM part
    UNION ALL SELECT 'suppliers', 0.5::DOUBLE, NULL, s_name FROM supplier UNION ALL SELECT 'customers', 2.5::DOUBLE, NULL, c_name FROM customer""",
)
def _(spark, folder):
    return blend.blend(spark, SPEC, load=lambda s: table(spark, folder, s["path"]))


def doc_sources(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.groupBy("lang").agg(F.sum(token_count("text")).alias("tokens")).select(
        F.col("lang").alias("dataset"), F.when(F.col("lang") == "en", 3.0).otherwise(1.0).alias("weight"), "tokens"
    )


@CATALOG.add(
    "blend_shares",
    f"""WITH s AS (SELECT lang AS dataset, CASE WHEN lang = 'en' THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, sum({token_count_sql()})::BIGINT AS tokens FROM documents GROUP BY lang)
    SELECT dataset, weight, tokens, round(weight / sum(weight) OVER (), 9) AS share, round(tokens::DOUBLE / sum(tokens) OVER (), 9) AS token_share FROM s""",
)
def _(spark, folder):
    out = blend.blend_shares(doc_sources(spark, folder))
    return out.select("dataset", "weight", "tokens", F.round("share", 9).alias("share"), F.round("token_share", 9).alias("token_share"))


@CATALOG.add(
    "sample_blend",
    f"""WITH w(dataset, weight) AS (VALUES ('en', 1.0::DOUBLE), ('fr', 2.0::DOUBLE), ('de', 1.0::DOUBLE), ('es', 0.5::DOUBLE)),
    want AS (SELECT dataset, round(weight / (SELECT sum(weight) FROM w) * 900)::BIGINT AS want FROM w),
    r AS (SELECT lang AS dataset, doc_id, {rank_sql(42, "doc_id", "lang")} AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents),
    c AS (SELECT dataset, doc_id, ceil((want - r + 1)::DOUBLE / n)::BIGINT AS copies FROM r JOIN want USING (dataset))
    SELECT dataset, doc_id, unnest(range(copies))::INTEGER AS copy FROM c WHERE copies > 0""",
)
def _(spark, folder):
    weights = spark.sql("SELECT * FROM VALUES ('en', 1.0D), ('fr', 2.0D), ('de', 1.0D), ('es', 0.5D) AS w(dataset, weight)")
    docs = table(spark, folder, "documents").select(F.col("lang").alias("dataset"), "doc_id")
    return blend.sample_blend(docs, weights, 900, "doc_id")


@CATALOG.add(
    "sample_blend_tokens",
    f"""WITH w(dataset, weight) AS (VALUES ('en', 1.0::DOUBLE), ('fr', 2.0::DOUBLE), ('de', 1.0::DOUBLE), ('es', 0.5::DOUBLE)),
    want AS (SELECT dataset, round(weight / (SELECT sum(weight) FROM w) * 200000)::BIGINT AS want FROM w),
    t AS (SELECT lang AS dataset, doc_id, {token_count_sql()} AS tokens FROM documents),
    r AS (SELECT *, sum(tokens) OVER (PARTITION BY dataset ORDER BY md5('42:' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) - tokens AS before,
      sum(tokens) OVER (PARTITION BY dataset) AS n FROM t),
    c AS (SELECT dataset, doc_id, tokens, ceil((want - before)::DOUBLE / n)::BIGINT AS copies FROM r JOIN want USING (dataset))
    SELECT dataset, doc_id, tokens, unnest(range(copies))::INTEGER AS copy FROM c WHERE copies > 0""",
)
def _(spark, folder):
    weights = spark.sql("SELECT * FROM VALUES ('en', 1.0D), ('fr', 2.0D), ('de', 1.0D), ('es', 0.5D) AS w(dataset, weight)")
    docs = table(spark, folder, "documents").select(F.col("lang").alias("dataset"), "doc_id", token_count("text").alias("tokens"))
    return blend.sample_blend(docs, weights, 200_000, "doc_id", tokens="tokens")


def sharded(spark, folder):
    return table(spark, folder, "documents").select(
        F.col("source").alias("dataset"), (F.col("doc_id") % 8).alias("shard"), token_count("text").alias("length"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )


STATS = f"""
d AS (SELECT source AS dataset, doc_id % 8 AS shard, {token_count_sql()} AS length, strlen(text) AS bytes FROM documents),
st AS (SELECT dataset, count(DISTINCT (dataset, shard)) AS num_shards, count(*) AS num_sequences, sum(length)::BIGINT AS total_tokens, sum(bytes)::BIGINT AS total_bytes
       FROM d GROUP BY ROLLUP (dataset))"""


@CATALOG.add("run_stats", f"WITH {STATS} SELECT * FROM st")
def _(spark, folder):
    return blend.run_stats(sharded(spark, folder))


@CATALOG.add(
    "run_lineage",
    f"WITH {STATS} SELECT st.dataset, 's3://corpus/' || st.dataset AS uri, num_shards, num_sequences, total_tokens, total_bytes FROM st WHERE dataset IS NOT NULL",
)
def _(spark, folder):
    sources = table(spark, folder, "documents").select(F.col("source").alias("dataset")).distinct()
    listed = sources.withColumn("uri", F.concat(F.lit("s3://corpus/"), "dataset"))
    return blend.lineage(blend.run_stats(sharded(spark, folder)), listed)


@CATALOG.add(
    "split_tokens",
    f"SELECT CASE WHEN doc_id % 10 = 0 THEN 'valid' ELSE 'train' END AS split, count(*) AS num_sequences, sum({token_count_sql()})::BIGINT AS total_tokens FROM documents GROUP BY 1",
)
def _(spark, folder):
    df = table(spark, folder, "documents").select(
        F.when(F.col("doc_id") % 10 == 0, "valid").otherwise("train").alias("split"), token_count("text").alias("length")
    )
    return blend.split_tokens(df)


@CATALOG.add(
    "progress_table",
    """SELECT event_type, count(*) AS total, count(*) FILTER (value > 5) AS started, count(*) FILTER (value > 20) AS completed,
    round(count(*) FILTER (value > 20)::DOUBLE / count(*) * 100, 1) AS percent,
    CASE WHEN count(*) FILTER (value > 20) = count(*) THEN 'completed' WHEN count(*) FILTER (value > 5) > 0 THEN 'in_progress' ELSE 'pending' END AS status
    FROM events GROUP BY event_type""",
)
def _(spark, folder):
    return blend.progress(table(spark, folder, "events"), "event_type", F.col("value") > 5, F.col("value") > 20)


@CATALOG.add(
    "metric_summary",
    """SELECT event_type, 'value' AS metric, round(avg(value), 6) AS mean, round(stddev(value), 6) AS std, round(sum(value), 4) AS sum FROM events GROUP BY event_type
    UNION ALL SELECT event_type, 'user_id', round(avg(user_id), 6), round(stddev(user_id), 6), round(sum(user_id)::DOUBLE, 4) FROM events GROUP BY event_type""",
)
def _(spark, folder):
    out = blend.metric_summary(table(spark, folder, "events"), ["value", "user_id"], by=["event_type"])
    return out.select("event_type", "metric", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), F.round("sum", 4).alias("sum"))
