"""Tokenization over documents."""

from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, TOKENS, hash_sql, heavy, table, token_count_sql
from quarry.functions.columns import token_count
from quarry.operators import bpe, tokens
from quarry.plans.checkpoints import cut_lineage

CATALOG = Catalog()

IDS = f"list_transform({TOKENS}, lambda t: {hash_sql('t')} % 50000 + 3)"


def coded(spark, folder):
    return tokens.tokenize(heavy(spark, folder))


def summary(ids="input_ids"):
    """Length, ends and an order-aware checksum of an id array."""
    total = F.aggregate(ids, F.lit(0).cast("bigint"), lambda s, x: (s * 31 + x) % 1000003)
    return [
        F.size(ids).cast("bigint").alias("n"),
        F.coalesce(F.get(ids, F.lit(0)).cast("bigint"), F.lit(-1)).alias("first"),
        F.coalesce(F.try_element_at(ids, F.lit(-1)).cast("bigint"), F.lit(-1)).alias("last"),
        total.alias("checksum"),
    ]


def summary_sql(ids="ids"):
    return (
        f"len({ids}) AS n, coalesce({ids}[1], -1)::BIGINT AS first, coalesce({ids}[-1], -1)::BIGINT AS last, "
        f"coalesce(list_reduce(list_prepend(0::BIGINT, {ids}), lambda s, x: (s * 31 + x) % 1000003), 0)::BIGINT AS checksum"
    )


@CATALOG.add("tokenize_regex", f"SELECT doc_id, {summary_sql()} FROM (SELECT doc_id, {IDS} AS ids FROM documents)")
def _(spark, folder):
    return coded(spark, folder).select("doc_id", *summary())


@CATALOG.add("tokenize_bytes", "SELECT doc_id, strlen(text) AS n FROM documents")
def _(spark, folder):
    out = tokens.tokenize(table(spark, folder, "documents"), tokenizer="bytes")
    return out.select("doc_id", F.size("input_ids").cast("bigint").alias("n"))


# Where the vocabulary files of public tokenizers are.
VOCABULARIES = "/opt/tokenizers"


def byte_pair_round_trip(spark, folder, tokenizer):
    """Ids of every text by merging, and the text that decoding makes of them."""
    out = tokens.tokenize(heavy(spark, folder), tokenizer=tokenizer)
    return out.select("doc_id", (F.size("input_ids") > 0).alias("coded"), F.md5(tokenizer.texts_of(F.col("input_ids"))).alias("decoded_md5"))


DECODED = "SELECT doc_id, length(text) > 0 AS coded, md5(text) AS decoded_md5 FROM documents"


@CATALOG.add("tokenize_rank_file", DECODED)
def _(spark, folder):
    return byte_pair_round_trip(spark, folder, bpe.RankFile(f"{VOCABULARIES}/byte_bpe_multi_50k.tiktoken"))


@CATALOG.add("tokenize_merge_list", DECODED)
def _(spark, folder):
    return byte_pair_round_trip(spark, folder, bpe.MergeList(f"{VOCABULARIES}/byte_bpe_50k.json"))


@CATALOG.add("tokenize_piece_model", DECODED)
def _(spark, folder):
    return byte_pair_round_trip(spark, folder, bpe.PieceModel(f"{VOCABULARIES}/piece_bpe_32k.model"))


WORD_PATTERN = r"''s|''t|''re|''ve|''m|''ll|''d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


@CATALOG.add(
    "tokenize_word_ends",
    f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(nfc_normalize(text)), '{WORD_PATTERN}') AS w FROM documents)
    SELECT doc_id, len(w) > 0 AS coded, md5(array_to_string(w, ' ')) AS decoded_md5 FROM w""",
)
def _(spark, folder):
    """Word-end merges keep words only: decoding gives them in lower case, with single spaces."""
    return byte_pair_round_trip(spark, folder, bpe.MergeList(f"{VOCABULARIES}/word_bpe_49k.json"))


@CATALOG.add(
    "tokenize_plugin",
    "SELECT doc_id, CASE WHEN length(text) >= 100 THEN len(string_split(text, ' ')) END AS n,"
    " length(text) < 100 AS failed FROM documents",
)
def _(spark, folder):
    """A user tokenizer that fails on short texts: only those rows lose their ids."""

    def factory():
        def encode(text):
            if len(text) < 100:
                raise ValueError("too short")
            return [len(part) for part in text.split(" ")]

        return encode

    run = tokens.plugin_tokenizer("word_lengths", factory)
    out = tokens.tokenize(table(spark, folder, "documents"), tokenizer=run, on_error="skip")
    return out.select(
        "doc_id",
        F.when(F.col("input_ids").isNotNull(), F.size("input_ids")).cast("bigint").alias("n"),
        F.col("error").isNotNull().alias("failed"),
    )


@CATALOG.add(
    "add_special_tokens",
    f"SELECT doc_id, {summary_sql()} FROM (SELECT doc_id, list_append(list_prepend(1, {IDS}), 2) AS ids FROM documents)",
)
def _(spark, folder):
    return tokens.add_special(coded(spark, folder), bos=1).select("doc_id", *summary())


@CATALOG.add(
    "truncate_tokens",
    f"SELECT doc_id, len(ids) > 256 AS truncated, {summary_sql('ids[1:256]')} FROM (SELECT doc_id, list_append({IDS}, 2) AS ids FROM documents)",
)
def _(spark, folder):
    out = tokens.truncate_tokens(tokens.add_special(coded(spark, folder)), 256)
    return out.select("doc_id", "truncated", *summary())


@CATALOG.add(
    "token_stats",
    f"""
    WITH t AS (SELECT source, length(text) < 50 AS short, {token_count_sql()} + 1 AS n FROM documents)
    SELECT source, count(*) AS num_input_rows, count(*) FILTER (short) AS num_filtered, 0 AS num_errors,
           count(*) FILTER (NOT short AND n > 512) AS num_truncated, count(*) FILTER (NOT short) AS num_sequences,
           coalesce(sum(least(n, 512)) FILTER (NOT short), 0)::BIGINT AS total_tokens,
           coalesce(min(least(n, 512)) FILTER (NOT short), 0)::BIGINT AS min_length,
           coalesce(max(least(n, 512)) FILTER (NOT short), 0)::BIGINT AS max_length FROM t GROUP BY source""",
)
def _(spark, folder):
    out = tokens.add_special(coded(spark, folder))
    return tokens.token_stats(out, by=["source"], min_chars=50, max_tokens=512)


@CATALOG.add(
    "index_layout",
    f"""
    WITH t AS (SELECT source, doc_id, {token_count_sql()} AS length FROM documents)
    SELECT source, doc_id, length, row_number() OVER w - 1 AS document_index,
           ((sum(length) OVER w - length) * 4)::BIGINT AS pointer FROM t WHERE length > 0
    WINDOW w AS (PARTITION BY source ORDER BY doc_id)""",
)
def _(spark, folder):
    # Stored, because the running sums read the lengths twice.
    docs = cut_lineage(heavy(spark, folder).select("source", "doc_id", token_count("text").alias("length")))
    return tokens.index_layout(docs, "doc_id", by=["source"])
