"""Placeholder lookups over conversations and benchmark; rollouts over events."""

from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, table
from quarry.catalog.records import chats
from quarry.operators import rollouts as rl
from quarry.plans.prefix import position

CATALOG = Catalog()

STYLES = {"math": "wrapped", "code": "template"}


def sources(spark, folder):
    """Benchmark passages as rows of two sources; every 7th of `code` has no question."""
    b = position(table(spark, folder, "benchmark"), "item_id", out="row")
    wrapped = F.concat(F.lit("Solve it.\n\n"), "text", F.lit("\n\nAnswer now."))
    math = b.select(F.lit("math").alias("dataset"), "row", wrapped.alias("question"),
                    F.concat(F.lit('["'), F.col("item_id"), F.lit('", 1]')).alias("answer"))
    code = b.select(F.lit("code").alias("dataset"), "row", F.when(F.col("row") % 7 != 0, F.col("text")).alias("question"),
                    F.concat(F.lit("x"), F.col("item_id")).alias("answer"))
    return math.unionByName(code)


def records(spark, folder):
    """Conversations; two thirds only point at a source row (some rows do not exist)."""
    i = F.col("conv_id")
    point = F.struct(
        i.alias("row"),
        F.when(i % 3 == 0, "Q: ").alias("prefix"),
        F.when(i % 6 == 0, "\n").alias("suffix"),
        F.when(i % 3 == 1, F.when(i % 2 == 0, "Write: {question}").otherwise("no marker")).alias("template"),
    )
    return chats(spark, folder).select(
        "conv_id",
        F.when(i % 3 == 0, "math").when((i % 3 == 1) & (i % 5 == 0), "other").when(i % 3 == 1, "code").alias("dataset"),
        F.when(i % 3 != 2, point).alias("placeholder"),
        F.struct(
            F.when(i % 3 == 2, F.col("messages")).alias("input"),
            F.lit(None).cast("array<struct<name:string>>").alias("tools"),
        ).alias("responses_create_params"),
    )


RESOLVED = """
b AS (SELECT item_id, text, row_number() OVER (ORDER BY item_id) - 1 AS row FROM benchmark),
c AS (SELECT DISTINCT conv_id FROM conversations),
res AS (SELECT conv_id, 'math' AS dataset, regexp_replace('Q: ' || text || CASE WHEN conv_id % 6 = 0 THEN chr(10) ELSE '' END, '\\n+$', '') AS question,
               regexp_replace('Q: ' || text || CASE WHEN conv_id % 6 = 0 THEN chr(10) ELSE '' END, '\\n+$', '') AS prompt, item_id::VARCHAR AS expected_answer
        FROM c JOIN b ON b.row = c.conv_id WHERE conv_id % 3 = 0
        UNION ALL
        SELECT conv_id, 'code', text, CASE WHEN conv_id % 2 = 0 THEN 'Write: ' || text ELSE text END, 'x' || item_id
        FROM c JOIN b ON b.row = c.conv_id WHERE conv_id % 3 = 1 AND conv_id % 5 <> 0 AND row % 7 <> 0)"""


@CATALOG.add(
    "resolve_placeholders",
    f"WITH {RESOLVED} SELECT conv_id, dataset, question, prompt, expected_answer FROM res",
)
def _(spark, folder):
    out = rl.resolve_placeholders(records(spark, folder), sources(spark, folder), STYLES, keep=["conv_id"])
    return out.select(
        "conv_id", "dataset", "question",
        F.get("responses_create_params.input", F.lit(0))["content"].alias("prompt"), "expected_answer",
    )


@CATALOG.add(
    "unplaced_placeholders",
    f"WITH {RESOLVED} SELECT conv_id FROM c WHERE conv_id % 3 <> 2 AND conv_id NOT IN (SELECT conv_id FROM res)",
)
def _(spark, folder):
    return rl.unplaced(records(spark, folder), sources(spark, folder)).select("conv_id")


PREP = f"""{RESOLVED},
al AS (SELECT conv_id, 'user:' || prompt AS chat, expected_answer FROM res
       UNION ALL SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY turn), NULL FROM conversations WHERE conv_id % 3 = 2 GROUP BY conv_id)"""


@CATALOG.add(
    "prep_rl",
    f"""WITH {PREP}, r AS (SELECT *, row_number() OVER (ORDER BY conv_id DESC) AS r, count(*) OVER () AS n FROM al)
    SELECT conv_id, chat, expected_answer, CASE WHEN n > 10 AND r <= 10 THEN 'val' ELSE 'train' END AS split FROM r""",
)
def _(spark, folder):
    out = rl.prep_rl(records(spark, folder), sources(spark, folder), STYLES, 10, "conv_id")
    flat = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return out.select("conv_id", flat.alias("chat"), "expected_answer", "split")


@CATALOG.add("nested_path", "SELECT conv_id, max(text) FILTER (turn = 0) AS first, max(text) FILTER (turn = 5) AS sixth FROM conversations GROUP BY conv_id")
def _(spark, folder):
    df = chats(spark, folder).withColumn("record", F.struct("messages"))
    at = lambda i: rl.get_path("record", ["messages", i, "content"])
    return df.select("conv_id", at(0).alias("first"), at(5).alias("sixth"))


@CATALOG.add("json_path", "SELECT event_id, props->>'$.k' AS k FROM events")
def _(spark, folder):
    return table(spark, folder, "events").select("event_id", rl.get_json_path("props", ["k"]).alias("k"))


@CATALOG.add(
    "restore_wrapped",
    "SELECT item_id, 'Task: ' || text || ' End' AS q FROM benchmark",
)
def _(spark, folder):
    wrapped = F.concat(F.lit("Intro\n\n"), "text", F.lit("\n\nOutro"))
    return table(spark, folder, "benchmark").select(
        "item_id", rl.restore_wrapped(wrapped, F.lit("Task: "), F.lit(" End\n\n")).alias("q")
    )


@CATALOG.add("restore_template", "SELECT item_id, CASE WHEN item_id % 2 = 0 THEN 'Do: ' || text || '!' ELSE text END AS q FROM benchmark")
def _(spark, folder):
    template = F.when(F.col("item_id") % 2 == 0, "Do: {question}!").otherwise("none")
    return table(spark, folder, "benchmark").select("item_id", rl.restore_template(F.col("text"), template).alias("q"))


@CATALOG.add(
    "parse_answer",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN (event_id + 1)::VARCHAR WHEN 2 THEN event_type
       WHEN 3 THEN 'not json ' || event_id ELSE '[]' END AS answer FROM events""",
)
def _(spark, folder):
    i = F.col("event_id")
    raw = (
        F.when(i % 5 == 0, F.concat(F.lit("["), i, F.lit(", 7]")))
        .when(i % 5 == 1, F.concat(F.lit('{"z": '), i + 1, F.lit(', "a": 5}')))
        .when(i % 5 == 2, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .when(i % 5 == 3, F.concat(F.lit("not json "), i))
        .otherwise("[]")
    )
    return table(spark, folder, "events").select("event_id", rl.parse_answer(raw).alias("answer"))


# --- rollouts: users are prompts, events are rollouts, value is the reward ---


@CATALOG.add(
    "curriculum",
    "SELECT user_id, round(avg(CASE WHEN value > 5 THEN 1.0::DOUBLE ELSE 0 END), 9) AS pass_rate, count(*) AS n FROM events GROUP BY user_id"
    " HAVING avg(CASE WHEN value > 5 THEN 1.0::DOUBLE ELSE 0 END) < 1",
)
def _(spark, folder):
    df = table(spark, folder, "events").withColumn("correct", F.when(F.col("value") > 5, 1.0).otherwise(0.0))
    return rl.curriculum(df, "user_id").withColumn("pass_rate", F.round("pass_rate", 9))


@CATALOG.add(
    "group_advantage",
    """WITH g AS (SELECT event_id, value, count(*) OVER w AS n, sum(value) OVER w AS s, stddev_samp(value) OVER w AS d FROM events WINDOW w AS (PARTITION BY user_id)),
    a AS (SELECT event_id, d, value - CASE WHEN n > 1 THEN (s - value) / (n - 1) ELSE 0 END AS a FROM g)
    SELECT event_id, round(CASE WHEN d > 0 THEN a / d ELSE a END, 6) AS advantage FROM a""",
)
def _(spark, folder):
    out = rl.group_advantage(table(spark, folder, "events"), "user_id", "event_id", "value")
    return out.select("event_id", F.round("advantage", 6).alias("advantage"))


@CATALOG.add(
    "circular_pairs",
    """WITH p AS (SELECT user_id, event_id, row_number() OVER w - 1 AS i, lead(event_id) OVER w AS nxt,
                  first_value(event_id) OVER w AS head FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT user_id, i, event_id, coalesce(nxt, head) AS next_event_id FROM p""",
)
def _(spark, folder):
    ev = position(table(spark, folder, "events").select("user_id", "event_id"), "event_id", by=["user_id"], out="i")
    return rl.circular_pairs(ev, "user_id", "i", keep=["event_id"])


@CATALOG.add("overlong_filter", "SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '[A-Za-z0-9_À-ÿ]+|[^A-Za-z0-9_À-ÿ\\s]')) + (CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END) < 400 OR doc_id % 2 = 0")
def _(spark, folder):
    from quarry.functions.columns import token_ids

    ids = F.concat(token_ids("text"), F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(2))).otherwise(F.array().cast("array<int>")))
    return rl.overlong_filter(table(spark, folder, "documents").withColumn("input_ids", ids), 400).select("doc_id")


@CATALOG.add(
    "reasoning_control",
    """WITH h AS (SELECT *, ('0x' || substr(md5('42:' || conv_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS h FROM conversations WHERE role = 'assistant')
    SELECT conv_id, turn, CASE WHEN h < 0.3 THEN NULL WHEN h < 0.7 THEN array_to_string(string_split(text, ' ')[1:5], ' ') ELSE text END AS reasoning FROM h""",
)
def _(spark, folder):
    df = table(spark, folder, "conversations").filter("role = 'assistant'").select(
        "conv_id", "turn", F.array(F.struct(F.col("role"), F.lit("x").alias("content"), F.col("text").alias("reasoning_content"))).alias("messages")
    )
    out = rl.reasoning_control(df, 0.3, 0.4, 5, "conv_id")
    return out.select("conv_id", "turn", F.get("messages", F.lit(0))["reasoning_content"].alias("reasoning"))
