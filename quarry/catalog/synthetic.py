"""Synthetic-data preparation and post-processing over documents."""

from functools import reduce

from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, heavy, strip_sql, token_count_sql
from quarry.operators import synthetic as syn

CATALOG = Catalog()


def documents(spark, folder):
    return heavy(spark, folder)


@CATALOG.add(
    "split_documents",
    "SELECT doc_id, i - 1 AS segment_id, md5(lines[i]) AS digest FROM"
    " (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))",
)
def _(spark, folder):
    out = syn.split_documents(documents(spark, folder))
    return out.select("doc_id", F.col("segment_id").cast("bigint").alias("segment_id"), F.md5("text").alias("digest"))


def joined_sql(limit, source="documents"):
    return f"""
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM {source}),
f AS (SELECT doc_id, line, {token_count_sql("line")} AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r
      FROM l WHERE {token_count_sql("line")} <= {limit}),
walk(doc_id, r, seg, n, line, lk) AS (
  SELECT doc_id, r, 0::BIGINT, n, line, n FROM f WHERE r = 1
  UNION ALL
  SELECT f.doc_id, f.r, CASE WHEN w.n + f.n <= {limit} THEN w.seg ELSE w.seg + 1 END,
         CASE WHEN w.n + f.n <= {limit} THEN w.n + f.n ELSE f.n END, f.line, f.n
  FROM walk w JOIN f ON f.doc_id = w.doc_id AND f.r = w.r + 1),
seg AS (SELECT doc_id, seg AS segment_id, string_agg(line, chr(10) ORDER BY r) AS text, sum(lk)::BIGINT AS segment_token_count
        FROM walk GROUP BY doc_id, seg)"""


@CATALOG.add(
    "join_segments",
    f"WITH RECURSIVE {joined_sql(200)} SELECT doc_id, segment_id, md5(text) AS digest, segment_token_count FROM seg",
)
def _(spark, folder):
    out = syn.join_segments(documents(spark, folder), 200)
    return out.select("doc_id", F.col("segment_id").cast("bigint").alias("segment_id"), F.md5("text").alias("digest"), "segment_token_count")


def prepared_sql(task):
    limits = syn.LIMITS[task]
    return f"""long_docs AS (SELECT * FROM documents WHERE {token_count_sql()} >= {limits['min_document']}),
{joined_sql(syn.max_segment_tokens(task), 'long_docs')},
ready AS (SELECT * FROM seg WHERE segment_token_count >= {limits['min_segment']})"""


def quoted(text):
    return "'" + text.replace("'", "''") + "'"


@CATALOG.add(
    "prepare_segments",
    f"WITH RECURSIVE {prepared_sql('distill')} SELECT doc_id, segment_id, md5(text) AS digest, segment_token_count FROM ready",
)
def _(spark, folder):
    out = syn.prepare_segments(documents(spark, folder), "distill")
    return out.select("doc_id", F.col("segment_id").cast("bigint").alias("segment_id"), F.md5("text").alias("digest"), "segment_token_count")


@CATALOG.add(
    "build_prompts",
    f"SELECT doc_id, md5({quoted(syn.SYSTEM)} || chr(10) || replace({quoted(syn.TEMPLATES['distill'])}, '{{text}}', text)) AS digest FROM documents",
)
def _(spark, folder):
    out = syn.build_prompts(documents(spark, folder), "distill")
    return out.select("doc_id", F.md5("prompt").alias("digest"))


@CATALOG.add("generate_echo", "SELECT doc_id, 'echo: ' || text AS reply FROM documents")
def _(spark, folder):
    """A stand-in client that answers with its prompt."""
    df = documents(spark, folder).select("doc_id", "text")
    return syn.generate(df, lambda: "echo: {}".format, prompt="text", out="reply").select("doc_id", "reply")


def replies(spark, folder):
    """Documents with made replies: two question pairs, a paraphrase, passages, a list."""
    c = F.col("text")
    head = F.replace(c, F.lit("\n"), F.lit(" "))
    pair = F.concat(F.lit("Question: **what** is it?\nAnswer: "), head)
    return documents(spark, folder).select(
        "doc_id",
        "text",
        F.concat(pair, F.lit("\n\n"), pair).alias("diverse_qa"),
        F.concat(F.when(F.col("doc_id") % 4 != 0, "Paraphrased Text: \"").otherwise("Here: \""), head, F.lit('"')).alias("distill"),
        F.concat(F.lit("Passage 1:\n*"), head, F.lit("*\nPassage:")).alias("extract_knowledge"),
        F.concat(F.lit("Here is the list:\n- "), head, F.lit("\n  - two\n3. three")).alias("knowledge_list"),
    )


REPLIES = """
h AS (SELECT doc_id, text, replace(text, chr(10), ' ') AS head FROM documents),
r AS (SELECT doc_id, text, 'Question: **what** is it?' || chr(10) || 'Answer: ' || head AS pair, head FROM h)"""


def markdown_sql(c):
    return rf"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c},
      '\*\*([^*]*)\*\*', '\1', 'g'), '\*([^*]*)\*', '\1', 'g'), '__([^_]*)__', '\1', 'g'),
      '_([^_]*)_', '\1', 'g'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g')"""


@CATALOG.add(
    "post_diverse_qa",
    f"""WITH {REPLIES},
    m AS (SELECT doc_id, text, {markdown_sql("pair || chr(10) || chr(10) || pair")} AS t FROM r
          WHERE {token_count_sql("(pair || chr(10) || chr(10) || pair)")} <= 598),
    p AS (SELECT doc_id, text, regexp_extract_all(t, '(Question:[^\n]*\n+Answer:[^\n]*)', 1) AS pairs FROM m),
    q AS (SELECT doc_id, text || chr(10) || chr(10) || array_to_string(pairs[1:greatest(1, {token_count_sql()} // 50)], chr(10) || chr(10)) AS t
          FROM p WHERE len(pairs) > 0)
    SELECT doc_id, md5(t) AS digest, {token_count_sql("t")} AS n FROM q WHERE {token_count_sql("t")} >= 100""",
)
def _(spark, folder):
    out = syn.post_diverse_qa(replies(spark, folder))
    return out.select("doc_id", F.md5("diverse_qa").alias("digest"), F.col("rephrased_document_token_count").alias("n"))


@CATALOG.add(
    "post_distill",
    f"""WITH {REPLIES},
    t AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN 'Paraphrased Text: "' ELSE 'Here: "' END || head || '"' AS t FROM r),
    m AS (SELECT doc_id, {markdown_sql("t")} AS t FROM t WHERE {token_count_sql("t")} <= 1598),
    s AS (SELECT doc_id, regexp_replace({strip_sql("substr(t, 18)")}, '^"([\\s\\S]*)"$', '\\1') AS t FROM m WHERE starts_with(t, 'Paraphrased Text:'))
    SELECT doc_id, md5(t) AS digest, {token_count_sql("t")} AS n FROM s WHERE {token_count_sql("t")} >= 50""",
)
def _(spark, folder):
    out = syn.post_distill(replies(spark, folder))
    return out.select("doc_id", F.md5("distill").alias("digest"), F.col("rephrased_document_token_count").alias("n"))


@CATALOG.add(
    "post_extract_knowledge",
    f"""WITH {REPLIES},
    t AS (SELECT doc_id, 'Passage 1:' || chr(10) || '*' || head || '*' || chr(10) || 'Passage:' AS t FROM r),
    m AS (SELECT doc_id, {markdown_sql("t")} AS t FROM t WHERE {token_count_sql("t")} <= 1398),
    s AS (SELECT doc_id, array_to_string(list_filter(string_split(t, chr(10)),
          lambda x: x NOT IN ('Passage:', 'Passage 1:', 'Passage 2:', 'Passage 3:')), chr(10)) AS t FROM m)
    SELECT doc_id, md5(t) AS digest, {token_count_sql("t")} AS n FROM s WHERE {token_count_sql("t")} >= 50""",
)
def _(spark, folder):
    out = syn.post_extract(replies(spark, folder))
    return out.select("doc_id", F.md5("extract_knowledge").alias("digest"), F.col("rephrased_document_token_count").alias("n"))


@CATALOG.add(
    "post_knowledge_list",
    f"""WITH {REPLIES},
    t AS (SELECT doc_id, 'Here is the list:' || chr(10) || '- ' || head || chr(10) || '  - two' || chr(10) || '3. three' AS t FROM r),
    m AS (SELECT doc_id, {markdown_sql("t")} AS t FROM t WHERE {token_count_sql("t")} <= 598),
    s AS (SELECT doc_id, array_to_string(list_transform(list_filter(string_split(t, chr(10)), lambda x, i: i > 1 OR regexp_matches(x, '^\\s*(?:[-*•]|[0-9]+[.)])\\s*')),
          lambda x: regexp_replace(x, '^\\s*(?:[-*•]|[0-9]+[.)])?\\s*', '')), chr(10)) AS t FROM m)
    SELECT doc_id, md5(t) AS digest, {token_count_sql("t")} AS n FROM s WHERE {token_count_sql("t")} >= 50""",
)
def _(spark, folder):
    out = syn.post_list(replies(spark, folder))
    return out.select("doc_id", F.md5("knowledge_list").alias("digest"), F.col("rephrased_document_token_count").alias("n"))


@CATALOG.add("run_generation_tasks")
def _(spark, folder):
    """All four tasks with a stand-in client that answers in every task's format."""

    def factory():
        def answer(prompt):
            body = " ".join(prompt.split("\n\n", 1)[-1].split())
            return f"Paraphrased Text: {body}\nQuestion: what?\nAnswer: {body}"

        return answer

    done = syn.run_tasks(documents(spark, folder).select("doc_id", "text"), factory)
    frames = [
        df.select(
            F.lit(task).alias("task"), "doc_id", "segment_id",
            F.col("rephrased_document_token_count").alias("n"),
        )
        for task, df in done.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)
