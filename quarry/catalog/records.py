"""Record transforms, filters and text modifiers over documents and conversations."""

from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, WORDS, heavy, strip_sql, table, token_count_sql
from quarry.functions import text as modify
from quarry.operators import filters, records
from quarry.operators.exact_dedup import distinct_sources
from quarry.sources import readers

CATALOG = Catalog()


def turn_pairs(spark, folder):
    """(conv_id, turn, prompt, reply, preamble) for every user turn; reply may be null."""
    c = table(spark, folder, "conversations")
    users = c.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    replies = c.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    return users.join(replies, ["conv_id", "turn"], "left")


PAIRS = """
pairs AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS reply
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""


def chats(spark, folder):
    return records.messages_from_turns(table(spark, folder, "conversations"))


def flat(messages="messages"):
    """Messages as one string, to compare array results as text."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")


FLAT = r"string_agg(role || ':' || text, chr(10) ORDER BY turn)"


@CATALOG.add("sft_records", f"WITH {PAIRS} SELECT prompt AS input, reply AS output FROM pairs WHERE reply IS NOT NULL")
def _(spark, folder):
    return records.sft(turn_pairs(spark, folder), input="prompt", output="reply")


@CATALOG.add(
    "sft_records_with_system",
    f"WITH {PAIRS} SELECT prompt AS input, reply AS output, s.text AS system FROM pairs p "
    "LEFT JOIN conversations s ON s.conv_id = p.conv_id AND s.role = 'system' WHERE reply IS NOT NULL",
)
def _(spark, folder):
    systems = (
        table(spark, folder, "conversations")
        .filter("role = 'system'")
        .select("conv_id", F.col("text").alias("instructions"))
    )
    pairs = turn_pairs(spark, folder).join(systems, "conv_id", "left")
    return records.sft(pairs, "prompt", "reply", "instructions").withColumnRenamed("instructions", "system")


@CATALOG.add("openai_chat", f"SELECT conv_id, count(*) AS n, {FLAT} AS chat FROM conversations GROUP BY conv_id")
def _(spark, folder):
    kept = chats(spark, folder).withColumn("messages", F.struct("conv_id", "messages"))
    out = records.openai_chat(kept)
    return out.select(
        "messages.conv_id", F.size("messages.messages").cast("bigint").alias("n"), flat("messages.messages").alias("chat")
    )


@CATALOG.add(
    "sharegpt",
    "SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END"
    " || '=' || text, chr(10) ORDER BY turn) AS turns FROM conversations GROUP BY conv_id",
)
def _(spark, folder):
    speaker = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    df = chats(spark, folder).select(
        F.struct(
            "conv_id",
            F.transform(
                "messages", lambda m: F.struct(speaker(m["role"]).alias("from"), m["content"].alias("value"))
            ).alias("turns"),
        ).alias("dialog")
    )
    return records.sharegpt(df, conversations="dialog").select(
        "conversations.conv_id",
        F.array_join(
            F.transform("conversations.turns", lambda t: F.concat(t["from"], F.lit("="), t["value"])), "\n"
        ).alias("turns"),
    )


@CATALOG.add(
    "rl_messages",
    f"SELECT conv_id, {FLAT} AS chat, CASE WHEN conv_id % 2 = 0 THEN 1 END AS n_tools"
    " FROM conversations GROUP BY conv_id HAVING conv_id % 5 <> 0",
)
def _(spark, folder):
    tool = F.struct(F.lit("search").alias("name"))
    params = F.struct(
        F.when(F.col("conv_id") % 5 != 0, F.col("messages")).alias("input"),
        F.when(F.col("conv_id") % 2 == 0, F.array(tool)).otherwise(F.slice(F.array(tool), 1, 0)).alias("tools"),
    )
    df = chats(spark, folder).withColumn("responses_create_params", params)
    out = records.rl_messages(df, keep=["conv_id"])
    return out.select("conv_id", flat().alias("chat"), F.size("tools").alias("n_tools"))


@CATALOG.add("passthrough_records", "SELECT item_id, text FROM benchmark")
def _(spark, folder):
    return records.passthrough(table(spark, folder, "benchmark"))


@CATALOG.add("select_fields", f"WITH {PAIRS} SELECT conv_id, turn, reply FROM pairs WHERE reply IS NOT NULL")
def _(spark, folder):
    return records.select_fields(turn_pairs(spark, folder), "conv_id", "turn", "reply")


@CATALOG.add("rename_fields", f"WITH {PAIRS} SELECT prompt AS question, reply AS answer FROM pairs WHERE reply IS NOT NULL")
def _(spark, folder):
    return records.rename_fields(turn_pairs(spark, folder), question="prompt", answer="reply")


@CATALOG.add(
    "custom_transform",
    "SELECT doc_id, upper(lang) AS code FROM documents WHERE n_chars >= 100",
)
def _(spark, folder):
    return records.apply_transform(
        table(spark, folder, "documents"),
        lambda d: d.filter("n_chars >= 100").select("doc_id", F.upper("lang").alias("code")),
    )


@CATALOG.add(
    "custom_row_transform",
    "SELECT user_id, event_type || ':' || event_id AS tag FROM events WHERE value >= 10",
)
def _(spark, folder):
    def tag(row):
        if row["value"] < 10:
            return None
        return {"user_id": row["user_id"], "tag": f"{row['event_type']}:{row['event_id']}"}

    return records.apply_transform(table(spark, folder, "events"), tag, "user_id long, tag string")


@CATALOG.add("messages_from_turns", f"SELECT conv_id, {FLAT} AS chat FROM conversations GROUP BY conv_id")
def _(spark, folder):
    return chats(spark, folder).select("conv_id", flat().alias("chat"))


@CATALOG.add("drop_columns", "SELECT doc_id, lang, source, n_chars FROM documents")
def _(spark, folder):
    return records.drop_columns(table(spark, folder, "documents"), "text", "not_there")


@CATALOG.add("concat_text", f"WITH {PAIRS} SELECT conv_id, turn, prompt || reply AS text FROM pairs")
def _(spark, folder):
    return records.concat_text(turn_pairs(spark, folder), "prompt", "reply").select("conv_id", "turn", "text")


@CATALOG.add(
    "add_doc_id",
    "SELECT page_id, url, row_number() OVER (ORDER BY page_id) - 1 AS id FROM pages",
)
def _(spark, folder):
    return records.add_doc_id(table(spark, folder, "pages").select("page_id", "url"), "page_id")


@CATALOG.add("require_keys", "SELECT event_id FROM events WHERE json_exists(props, '$.k')")
def _(spark, folder):
    return records.require_keys(table(spark, folder, "events"), "props", "k").select("event_id")


@CATALOG.add(
    "limit_rows_per_source",
    "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 7",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("source", "doc_id")
    return records.limit_rows(docs, 7, by="source", order="doc_id")


@CATALOG.add("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25")
def _(spark, folder):
    return records.limit_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 25, order="o_orderkey")


# --- filters -----------------------------------------------------------------


@CATALOG.add("min_chars", "SELECT doc_id, length(text) AS chars FROM documents WHERE length(text) >= 200")
def _(spark, folder):
    return filters.min_chars(table(spark, folder, "documents"), 200).select(
        "doc_id", F.char_length("text").cast("bigint").alias("chars")
    )


@CATALOG.add("keep_languages", "SELECT doc_id, lang FROM documents WHERE upper(lang) IN ('EN', 'DE')")
def _(spark, folder):
    return filters.keep_languages(table(spark, folder, "documents"), ["en", "DE"]).select("doc_id", "lang")


@CATALOG.add("score_filter", "SELECT event_id, value FROM events WHERE value >= 0.3 AND value <= 20")
def _(spark, folder):
    return filters.score_filter(table(spark, folder, "events"), "value", 0.3, 20).select("event_id", "value")


@CATALOG.add(
    "token_count_filter",
    f"SELECT doc_id, token_count FROM (SELECT doc_id, {token_count_sql()} AS token_count FROM documents)"
    " WHERE token_count BETWEEN 30 AND 1000",
)
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return filters.token_count_filter(docs, min=30, max=1000).select("doc_id", "token_count")


@CATALOG.add("substring_filter", "SELECT doc_id FROM documents WHERE starts_with(text, 'The')")
def _(spark, folder):
    return filters.substring_filter(table(spark, folder, "documents"), "text", "The", "prefix").select("doc_id")


@CATALOG.add(
    "used_in_filter",
    """
    WITH t AS (SELECT event_id, event_type || ', ' || CASE WHEN value > 10 THEN 'sft' ELSE 'rl' END AS used_in FROM events)
    SELECT event_id FROM t WHERE used_in = 'sft'
      OR list_contains(list_transform(string_split(used_in, ','), lambda x: trim(x)), 'sft')""",
)
def _(spark, folder):
    tags = F.concat("event_type", F.lit(", "), F.when(F.col("value") > 10, "sft").otherwise("rl"))
    df = table(spark, folder, "events").withColumn("used_in", tags)
    return filters.used_in(df, "used_in", "sft").select("event_id")


@CATALOG.add(
    "non_empty_messages",
    "SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'system' GROUP BY conv_id",
)
def _(spark, folder):
    only_system = chats(spark, folder).withColumn(
        "messages", F.filter("messages", lambda m: m["role"] == "system")
    )
    return filters.non_empty(only_system).select("conv_id", F.size("messages").cast("bigint").alias("n"))


@CATALOG.add(
    "valid_conversation",
    """
    WITH c AS (SELECT conv_id, bool_or(role = 'user' AND text ILIKE '%the%') AS called,
                      bool_or(role = 'system') AS header FROM conversations GROUP BY conv_id)
    SELECT conv_id FROM c WHERE NOT called OR header""",
)
def _(spark, folder):
    marked = F.transform(
        "messages",
        lambda m: F.struct(
            m["role"].alias("role"),
            F.when((m["role"] == "user") & m["content"].ilike("%the%"), F.concat(m["content"], F.lit("<tool_call>")))
            .when(m["role"] == "system", F.concat(F.lit("# Tools\n"), m["content"]))
            .otherwise(m["content"])
            .alias("content"),
        ),
    )
    return filters.valid_conversation(chats(spark, folder).withColumn("messages", marked)).select("conv_id")


@CATALOG.add(
    "max_length",
    f"SELECT doc_id, length FROM (SELECT doc_id, {token_count_sql()} AS length FROM documents) WHERE length <= 512",
)
def _(spark, folder):
    from quarry.functions.columns import token_count

    docs = table(spark, folder, "documents").select("doc_id", token_count("text").alias("length"))
    return filters.max_length(docs, 512)


@CATALOG.add(
    "row_modulus",
    """
    WITH p AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM documents)
    SELECT source, doc_id FROM p WHERE i % 3 = 1""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("source", "doc_id")
    return filters.row_modulus(docs, 3, 1, order="doc_id", by=["source"])


@CATALOG.add(
    "repetition_filter",
    f"""
    WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
    g AS (SELECT doc_id, CASE WHEN len(w) < 4 THEN [] ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i+3]) END AS g FROM w)
    SELECT doc_id, round(CASE WHEN len(g) > 0 THEN 1 - len(list_distinct(g))::DOUBLE / len(g) ELSE 0 END, 6) AS share
    FROM g WHERE CASE WHEN len(g) > 0 THEN 1 - len(list_distinct(g))::DOUBLE / len(g) ELSE 0 END <= 0.3""",
)
def _(spark, folder):
    docs = filters.repetition_filter(heavy(spark, folder))
    return docs.select("doc_id", F.round("repetition_share", 6).alias("share"))


@CATALOG.add(
    "structural_filter",
    """
    SELECT conv_id FROM conversations GROUP BY conv_id
    HAVING bool_and(role IN ('system', 'user', 'assistant', 'tool')) AND bool_or(role = 'assistant')
       AND bool_and(length(trim(text)) > 0)""",
)
def _(spark, folder):
    return filters.structural_filter(chats(spark, folder)).select("conv_id")


def pii_sql(what):
    return {
        "email": filters.EMAIL,
        "ssn": filters.SSN,
        "phone": filters.PHONE,
    }[what]


@CATALOG.add(
    "pii_flags",
    f"""
    SELECT doc_id, len(regexp_extract_all(text, '{pii_sql("email")}')) AS n_emails,
           len(regexp_extract_all(text, '{pii_sql("ssn")}')) AS n_ssns,
           len(regexp_extract_all(text, '{pii_sql("phone")}')) AS n_phones FROM documents""",
)
def _(spark, folder):
    return filters.pii_flags(heavy(spark, folder)).select("doc_id", "n_emails", "n_ssns", "n_phones")


@CATALOG.add(
    "pii_redact",
    f"""
    SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{pii_sql("email")}', '[EMAIL]', 'g'),
           '{pii_sql("ssn")}', '[SSN]', 'g'), '{pii_sql("phone")}', '[PHONE]', 'g') AS text FROM documents""",
)
def _(spark, folder):
    return filters.pii_redact(heavy(spark, folder)).select("doc_id", "text")


@CATALOG.add(
    "filter_subtype",
    """
    SELECT page_id FROM pages WHERE html LIKE '%<table%'""",
)
def _(spark, folder):
    is_table = F.col("html").contains("<table")
    meta = F.struct(
        F.struct(F.lit("structured").alias("type"), F.when(is_table, "table").alias("subtype")).alias("content_metadata")
    )
    return filters.filter_subtype(table(spark, folder, "pages").withColumn("metadata", meta), "table").select("page_id")


@CATALOG.add(
    "item_modality",
    """
    SELECT page_id, CASE WHEN html LIKE '%<img%' AND html LIKE '%<p>%' THEN 'image_text'
                         WHEN html LIKE '%<img%' THEN 'image' WHEN html LIKE '%<p>%' THEN 'text' END AS modality FROM pages""",
)
def _(spark, folder):
    html = F.col("html")
    df = table(spark, folder, "pages").select(
        "page_id",
        F.struct(F.struct(F.when(html.contains("<img"), html).alias("content")).alias("image_metadata")).alias("metadata"),
        F.when(html.contains("<p>"), html).alias("text"),
    )
    return filters.modality(df).select("page_id", "modality")


# --- text modifiers ----------------------------------------------------------


@CATALOG.add(
    "remove_markdown",
    r"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
      '\*\*([^*]*)\*\*', '\1', 'g'), '\*([^*]*)\*', '\1', 'g'), '__([^_]*)__', '\1', 'g'),
      '_([^_]*)_', '\1', 'g'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g')) AS digest FROM documents""",
)
def _(spark, folder):
    return heavy(spark, folder).select("doc_id", F.md5(modify.remove_markdown("text")).alias("digest"))


@CATALOG.add(
    "remove_lines",
    """
    SELECT doc_id, md5(array_to_string(list_filter(string_split(text, chr(10)), lambda x: x NOT IN ('', 'Passage:')), chr(10)))
      AS digest FROM documents""",
)
def _(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(modify.remove_lines("text", ["", "Passage:"])).alias("digest")
    )


@CATALOG.add(
    "slice_after",
    f"""
    SELECT doc_id, CASE WHEN instr(text, '. ') > 0 THEN {strip_sql("substr(text, instr(text, '. ') + 2)")} ELSE '' END AS rest
    FROM documents""",
)
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", modify.slice_after("text", ". ").alias("rest"))


@CATALOG.add("unquote", "SELECT p_partkey, p_name AS name FROM part")
def _(spark, folder):
    quoted = F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))
    return table(spark, folder, "part").select("p_partkey", modify.unquote(quoted).alias("name"))


@CATALOG.add("truncate_chars", "SELECT doc_id, substr(text, 1, 1000) AS head FROM documents")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", modify.truncate_chars("text", 1000).alias("head"))


@CATALOG.add("fix_unicode", "SELECT doc_id, nfc_normalize(text) AS text FROM documents")
def _(spark, folder):
    """The text is first broken (UTF-8 bytes read as Latin-1), then repaired."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, folder, "documents").select("doc_id", modify.fix_unicode(broken).alias("text"))


# --- sources -----------------------------------------------------------------


@CATALOG.add("read_parquet_columns", "SELECT doc_id, lang FROM documents")
def _(spark, folder):
    return readers.read_parquet(spark, f"{folder}/documents.parquet", ["doc_id", "lang"])


@CATALOG.add("read_table", "SELECT c_custkey, c_mktsegment FROM customer")
def _(spark, folder):
    return readers.read_table(spark, f"{folder}/customer.parquet").select("c_custkey", "c_mktsegment")


NAMES = (
    "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'data/train-' || doc_id || '.parquet' WHEN 1 THEN 'training-' || doc_id || '.parquet'"
    " WHEN 2 THEN source || '/train/' || doc_id || '.json' WHEN 3 THEN 'train.jsonl' WHEN 4 THEN 'data/' || source || '_x.parquet'"
    " ELSE 'data/' || source || '.jsonl' END AS path FROM documents"
)


def file_names(spark, folder):
    table(spark, folder, "documents").createOrReplaceTempView("named_documents")
    return spark.sql(NAMES.replace("FROM documents", "FROM named_documents"))


@CATALOG.add("files_for_split", f"SELECT * FROM ({NAMES}) WHERE regexp_matches(path, '(^|/)train(-|/|\\.|$)')")
def _(spark, folder):
    return readers.files_for_split(file_names(spark, folder), "train")


@CATALOG.add(
    "files_for_subset",
    f"""SELECT * FROM ({NAMES}) WHERE contains(path, '/src2/') OR starts_with(path, 'src2/') OR contains(path, '/src2-')
        OR contains(path, '/src2_') OR starts_with(path, 'src2-') OR starts_with(path, 'src2_') OR contains(path, '/src2.')""",
)
def _(spark, folder):
    return readers.files_for_subset(file_names(spark, folder), "src2")


@CATALOG.add("distinct_sources", "SELECT source, lang, min(doc_id) AS first_seen FROM documents GROUP BY source, lang")
def _(spark, folder):
    return distinct_sources(table(spark, folder, "documents"), ["source", "lang"], "doc_id")


@CATALOG.add("file_inventory")
def _(spark, folder):
    return readers.file_inventory(spark, folder)
