"""Retrieval, text-to-SQL, layout and safety queries."""

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

from quarry.catalog.base import Catalog, hash_sql, heavy, table, token_count_sql
from quarry.functions.text import split_thinking
from quarry.operators import layout, retrieval, safety, text2sql
from quarry.operators.minhash import text_hash
from quarry.operators.retrieval import words_of
from quarry.plans.checkpoints import cut_lineage, drop_stored

CATALOG = Catalog()


@CATALOG.add("chunk_documents")
def _(spark, folder):
    docs = heavy(spark, folder)
    out = retrieval.chunk(docs)
    return out.select("doc_id", "chunk_id", F.char_length("chunk").alias("n"), F.md5("chunk").alias("digest"))


VEC = "list_transform(embedding, lambda x: x::DOUBLE)"


def rounded(column):
    """All coordinates, as text with six digits."""
    return F.array_join(F.transform(column, lambda x: F.round(x * 1_000_000).cast("bigint").cast("string")), ",")


def rounded_sql(column):
    return f"array_to_string(list_transform({column}, lambda x: round(x * 1000000)::BIGINT), ',')"


@CATALOG.add(
    "l2_normalize",
    f"""WITH v AS (SELECT vec_id, {VEC} AS v FROM embeddings),
    n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM v)
    SELECT vec_id, {rounded_sql("list_transform(v, lambda x: x / n)")} AS unit FROM n""",
)
def _(spark, folder):
    unit = table(spark, folder, "embeddings").select("vec_id", retrieval.l2_normalize("embedding").alias("u"))
    return unit.select("vec_id", rounded("u").alias("unit"))


@CATALOG.add(
    "mean_pool",
    f"""WITH v AS (SELECT vec_id, {VEC} AS v FROM embeddings)
    SELECT vec_id, {rounded_sql("list_transform(range(1, 9), lambda j: (v[j] + v[16 + j] + v[32 + j] + v[48 + j]) / 4)")} AS pooled FROM v""",
)
def _(spark, folder):
    """Each embedding as eight token vectors of eight numbers; every second token is masked out."""
    tokens = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8).cast("array<double>"))
    mask = F.array(*[F.lit(1 - i % 2) for i in range(8)])
    df = table(spark, folder, "embeddings").select("vec_id", tokens.alias("t"), mask.alias("m"))
    return df.select("vec_id", rounded(retrieval.mean_pool("t", "m")).alias("pooled"))


def vectors(spark, folder, id):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias(id), F.col("embedding").alias("vector"))


def near_sql(score, k):
    return f"""
v AS (SELECT vec_id, {VEC} AS v, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings),
pair AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id, round({score}, 9) AS score FROM v q, v i),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM pair
         QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) <= {k})"""


COSINE = "list_dot_product(q.v, i.v) / (q.n * i.n)"


@CATALOG.add("knn_cosine", f"WITH {near_sql(COSINE, 10)} SELECT query_id, item_id, rank, round(score, 6) AS score FROM near")
def _(spark, folder):
    out = retrieval.knn(vectors(spark, folder, "query_id"), vectors(spark, folder, "item_id"), 10)
    return out.select("query_id", "item_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


@CATALOG.add(
    "knn_inner_product",
    f"WITH {near_sql('list_dot_product(q.v, i.v)', 5)} SELECT query_id, item_id, rank, round(score, 6) AS score FROM near",
)
def _(spark, folder):
    out = retrieval.knn(vectors(spark, folder, "query_id"), vectors(spark, folder, "item_id"), 5, cosine=False)
    return out.select("query_id", "item_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


# Every document gets a vector of its text: one more than its number of words per class of hashes.
CLASSES = 16
TEXT_VECTOR = (
    f"(SELECT doc_id AS vec_id, list_transform(range({CLASSES}), lambda j: (1 + len(list_filter(h, lambda x: x = j)))::DOUBLE) AS embedding FROM ("
    f"SELECT doc_id, list_transform(regexp_extract_all(lower(text), '[A-Za-z0-9_À-ÿ]+'), lambda w: {hash_sql('w')} % {CLASSES}) AS h FROM documents))"
)
RERANK = f"""{near_sql(COSINE, 6).replace("FROM embeddings)", f"FROM {TEXT_VECTOR})")},
w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[A-Za-z0-9_À-ÿ]+')) AS w FROM documents),
sc AS (SELECT query_id, item_id, CASE WHEN len(a.w) > 0 THEN len(list_intersect(a.w, b.w))::DOUBLE / len(a.w) ELSE 0 END AS s
       FROM near JOIN w a ON a.doc_id = query_id JOIN w b ON b.doc_id = item_id),
best AS (SELECT query_id, item_id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, item_id) AS r FROM sc
         QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, item_id) <= 3)"""


@F.pandas_udf(T.ArrayType(T.FloatType()))
def word_classes(texts: pd.Series) -> pd.Series:
    """One more than a lower-case text's number of words in each class of hashes; null numbers for null."""
    known = lru_cache(1 << 16)(lambda w: text_hash(w.decode("latin-1")) % CLASSES)

    def count(text):
        if text is None:
            return [None] * CLASSES
        return np.bincount(np.fromiter(map(known, words_of(text)), np.int64), minlength=CLASSES).astype(np.float32) + 1

    return texts.map(count)


def reranked(spark, folder, each, about=None):
    """All documents ask and are offered, with a vector of their text."""
    docs = heavy(spark, folder)
    stored = cut_lineage(docs.select("doc_id", word_classes(F.lower("text")).alias("vector")))
    sides = [F.col("doc_id").alias(c) for c in ("query_id", "item_id")]
    out = retrieval.retrieve_and_rerank(
        *(docs.select(c, "text") for c in sides), 3, vectors=[stored.select(c, "vector") for c in sides], about=about, each=each
    )
    drop_stored(stored)
    return out


@CATALOG.add(
    "retrieve_and_rerank",
    f"WITH {RERANK} SELECT query_id, item_id, r AS rerank, round(s, 6) AS rerank_score FROM best",
)
def _(spark, folder):
    rerank = F.col("rerank").cast("bigint").alias("rerank")
    return reranked(spark, folder, lambda hits: hits.select("query_id", "item_id", rerank, F.round("rerank_score", 6).alias("rerank_score")))


@CATALOG.add(
    "build_context",
    f"""WITH {RERANK} SELECT query_id, md5(string_agg('[Source ID: ' || r || ' | Type: ' || upper(lang) || ' | Page: ' || item_id || ']' || chr(10)
        || text || chr(10) || chr(10), '' ORDER BY r)) AS digest FROM best JOIN documents ON doc_id = item_id GROUP BY query_id""",
)
def _(spark, folder):
    langs = table(spark, folder, "documents").groupBy(F.col("doc_id").alias("item_id")).agg(F.collect_list(F.struct("lang")).alias("langs"))

    def digests(hits):
        out = retrieval.build_context(hits.select("*", F.inline("langs")), rank="rerank", kind="lang", page="item_id", text="passage")
        return out.select("query_id", F.md5("context").alias("digest"))

    return reranked(spark, folder, digests, langs)


@CATALOG.add(
    "split_thinking",
    """SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN trim(text, E' \\n') ELSE '' END AS reasoning,
       CASE WHEN turn % 2 = 1 THEN role ELSE text END AS answer FROM conversations""",
)
def _(spark, folder):
    c = table(spark, folder, "conversations")
    reply = F.when(
        F.col("turn") % 2 == 1, F.concat(F.lit("<think>\n"), "text", F.lit("\n</think>\n\n"), "role")
    ).otherwise(F.col("text"))
    return c.select("conv_id", "turn", split_thinking(reply).alias("s")).select("conv_id", "turn", "s.reasoning", "s.answer")


# --- text to SQL -------------------------------------------------------------


def sql_rows(spark, folder, reasoning=False):
    p = table(spark, folder, "part")
    return p.select(
        "p_partkey",
        F.concat(F.lit("part("), "p_type", F.lit(")")).alias("schema"),
        F.concat(F.lit("How many "), "p_name", F.lit("?")).alias("question"),
        F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("").alias("evidence"),
        F.concat(F.lit(" SELECT count(*) FROM part WHERE p_size = "), "p_size", F.lit(" ")).alias("SQL"),
        F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("think "), "p_name")).alias("reasoning_trace"),
    )


def pair_sql(reasoning):
    sql = "'SELECT count(*) FROM part WHERE p_size = ' || p_size"
    raw = "' SELECT count(*) FROM part WHERE p_size = ' || p_size"
    output = f"CASE WHEN p_partkey % 3 <> 0 THEN 'think ' || p_name || chr(10) || '</think>' || chr(10) || chr(10) || {raw} ELSE {sql} END" if reasoning else sql
    return f"""SELECT p_partkey, 'part(' || p_type || ')' || chr(10) || chr(10) || 'How many ' || p_name || '?'
      || CASE WHEN p_size > 25 THEN chr(10) || p_brand ELSE '' END AS input, {output} || '<|im_end|>' AS output FROM part"""


@CATALOG.add("text_to_sql_pairs", pair_sql(False))
def _(spark, folder):
    return text2sql.sql_sft(sql_rows(spark, folder)).select("p_partkey", "input", "output")


@CATALOG.add("text_to_sql_reasoning_pairs", pair_sql(True))
def _(spark, folder):
    return text2sql.sql_sft(sql_rows(spark, folder), reasoning=True).select("p_partkey", "input", "output")


@CATALOG.add(
    "prep_text_to_sql",
    f"""WITH u AS ({pair_sql(False)} UNION ALL {pair_sql(True)}),
    t AS (SELECT p_partkey, input, output, {token_count_sql("(input || output)")} AS length FROM u)
    SELECT p_partkey, input, output, length FROM t WHERE length <= 38""",
)
def _(spark, folder):
    rows = sql_rows(spark, folder)
    return text2sql.prep_text2sql(rows, rows, max_tokens=38, keep=["p_partkey"]).drop("text")


# --- layout ------------------------------------------------------------------

KINDS = ["Title", "Section-header", "List-item", "List-item", "Text", "Formula", "Caption", "Footnote", "Table"]


def blocks(spark, folder):
    """Documents as pages, lines as blocks; the type follows from the line number."""
    lines = heavy(spark, folder).select(
        F.col("doc_id").alias("page"), F.posexplode_outer(F.split("text", "\n")).alias("id", "text")
    )
    kinds = F.array(*[F.lit(k) for k in KINDS])
    number = F.pmod(F.col("id") * 5 + F.col("page"), F.lit(len(KINDS)))
    box = F.struct(
        ((F.col("id") % 10) / 10).alias("xmin"), F.lit(0.125).alias("ymin"), F.lit(0.5).alias("xmax"), F.lit(0.75).alias("ymax")
    )
    return lines.withColumn("type", F.get(kinds, number.cast("int"))).withColumn("bbox", F.when(F.col("id") % 4 != 3, box))


BLOCKS = f"""
bl AS (SELECT doc_id AS page, i AS id, line AS text, ([{", ".join(f"'{k}'" for k in KINDS)}])[((i * 5 + doc_id) % {len(KINDS)}) + 1] AS type FROM
       (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents))"""


@CATALOG.add(
    "blocks_to_records",
    f"""WITH {BLOCKS} SELECT page, id, type, CASE WHEN id % 4 <> 3 THEN trunc((id % 10)::DOUBLE / 10 * 1000)::BIGINT ELSE 0 END AS x0,
      CASE WHEN id % 4 <> 3 THEN 1050 ELSE 0 END AS y1 FROM bl""",
)
def _(spark, folder):
    out = layout.blocks_to_records(blocks(spark, folder), 1000, 1400)
    at = lambda i: F.get("bbox_px", F.lit(i)).cast("bigint")
    return out.select("page", F.col("id").cast("bigint").alias("id"), "type", at(0).alias("x0"), at(3).alias("y1"))


@CATALOG.add("blocks_preview", "SELECT doc_id, substr(replace(text, chr(10), ' '), 1, 200) AS text FROM documents")
def _(spark, folder):
    return layout.blocks_preview(table(spark, folder, "documents")).select("doc_id", "text")


TRIM = r"regexp_replace({}, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g')"


@CATALOG.add(
    "page_markdown",
    rf"""WITH {BLOCKS},
    n AS (SELECT page, id, type, {TRIM.format("text")} AS raw FROM bl),
    c AS (SELECT page, id, type, raw, {TRIM.format(r"replace(regexp_replace(raw, '\\([#>*_`~\-+!\[\]()])', '\1', 'g'), '•', '-')")} AS t FROM n WHERE length(raw) > 0),
    b AS (SELECT *, last_value(CASE WHEN type <> 'Text' THEN type END IGNORE NULLS) OVER (PARTITION BY page ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state,
      CASE type WHEN 'Table' THEN '<p>' || raw || '</p>' WHEN 'Formula' THEN '<pre><code>$$ ' || raw || ' $$</code></pre>'
        WHEN 'Title' THEN CASE WHEN starts_with(t, '#') THEN t ELSE '# ' || t END
        WHEN 'Section-header' THEN CASE WHEN starts_with(t, '##') THEN t ELSE '## ' || t END
        WHEN 'List-item' THEN '- ' || t WHEN 'Caption' THEN '> Caption: ' || t
        WHEN 'Footnote' THEN '<p><small>[Footnote] ' || t || '</small></p>' ELSE t END AS body FROM c),
    l AS (SELECT page, id, CASE WHEN type NOT IN ('Text', 'List-item') AND coalesce(state = 'List-item', false) THEN chr(10) ELSE '' END || body
          || CASE WHEN type = 'List-item' THEN '' ELSE chr(10) END AS x FROM b)
    SELECT page, md5({TRIM.format("string_agg(x, chr(10) ORDER BY id)")}) AS digest FROM l GROUP BY page""",
)
def _(spark, folder):
    df = blocks(spark, folder).withColumn(
        "html", F.concat(F.lit("<p>"), layout.strip("text"), F.lit("</p>"))
    )
    return layout.page_markdown(df, table_html="html").select("page", F.md5("markdown").alias("digest"))


@CATALOG.add(
    "latex_tables",
    r"""SELECT p_partkey, '<table border="1" class="dataframe">' || chr(10) || '  <tr>' || chr(10) || '    <th rowspan="2">' || p_name || '</th>' || chr(10)
      || '    <th colspan="2"><b>' || p_brand || '</b> & Co</th>' || chr(10) || '  </tr>' || chr(10) || '  <tr>' || chr(10)
      || '    <td>' || p_type || '</td>' || chr(10) || '    <td>' || p_size || '</td>' || chr(10) || '  </tr>' || chr(10) || '</table>' AS html, '0,0;0,1;1,1;1,2' AS places FROM part""",
)
def _(spark, folder):
    latex = F.concat(
        F.lit("\\begin{tabular}{lll}\n\\hline\n\\multirow{2}{*}{"), "p_name", F.lit("} & \\multicolumn{2}{c}{\\textbf{"), "p_brand",
        F.lit("} \\& Co} \\\\ \\hline\n "), "p_type", F.lit(" & "), F.col("p_size").cast("string"), F.lit(" \\\\\n\\end{tabular}"),
    )
    out = layout.latex_tables(table(spark, folder, "part").select("p_partkey", latex.alias("latex")))
    places = F.array_join(F.transform("cells", lambda c: F.concat(c["row"], F.lit(","), c["col"])), ";")
    return out.select("p_partkey", "html", places.alias("places"))


# --- safety ------------------------------------------------------------------


def verdicts(spark, folder):
    """Model replies made from the toxicity labels; every ninth is broken."""
    toxic = F.col("toxic") == 1
    json = F.concat(
        F.lit('{"User Safety": "'), F.when(toxic, "unsafe").otherwise("Safe"), F.lit('"'),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(', "Response Safety": "'), F.when(F.col("doc_id") % 4 == 0, "unsafe").otherwise("safe"), F.lit('"'))).otherwise(""),
        F.when(toxic, ', "Safety Categories": "Violence, Harassment"').otherwise(""), F.lit("}"),
    )
    return table(spark, folder, "labels").select(
        "doc_id", F.when(F.col("doc_id") % 9 == 0, "I cannot say").otherwise(json).alias("reply")
    )


@CATALOG.add(
    "safety_verdict",
    """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'unknown' WHEN toxic = 1 THEN 'unsafe' ELSE 'Safe' END AS "user",
       CASE WHEN doc_id % 9 <> 0 AND doc_id % 2 = 0 THEN CASE WHEN doc_id % 4 = 0 THEN 'unsafe' ELSE 'safe' END END AS response,
       doc_id % 9 <> 0 AND toxic = 0 AND doc_id % 4 <> 0 AS safe FROM labels""",
)
def _(spark, folder):
    df = verdicts(spark, folder).withColumn("v", safety.safety_verdict("reply"))
    return df.select("doc_id", "v.user", "v.response", "v.safe")


@CATALOG.add(
    "safety_categories",
    "SELECT category, count(*) AS n FROM labels, (SELECT unnest(['Violence', 'Harassment']) AS category) WHERE toxic = 1 AND doc_id % 9 <> 0 GROUP BY category",
)
def _(spark, folder):
    df = verdicts(spark, folder).select(safety.safety_verdict("reply").alias("v")).select("v.categories")
    return safety.safety_categories(df)


@CATALOG.add(
    "safety_prompt",
    """SELECT conv_id, turn, md5('Task: Check the conversation for unsafe content.' || chr(10) || chr(10) || '<BEGIN CONVERSATION>' || chr(10) || chr(10) || 'user: ' || text
       || chr(10) || '<END CONVERSATION>' || chr(10) || chr(10) || 'Answer as JSON with "User Safety", "Response Safety" and "Safety Categories".') AS digest FROM conversations""",
)
def _(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", F.md5(safety.safety_prompt(F.col("text"))).alias("digest"))
