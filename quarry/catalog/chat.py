"""Chat rendering, masks and packing over conversations and orders."""

from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, TOKENS, hash_sql, strip_sql, table, token_count_sql
from quarry.catalog.records import chats
from quarry.operators import chat, packing

CATALOG = Catalog()


def thinking_chats(spark, folder):
    """Every third conversation gets reasoning on its assistant turns (turn > 1 only)."""
    df = chat.full_messages(chats(spark, folder))
    think = lambda m, i: F.when(
        (F.col("conv_id") % 3 == 0) & (m["role"] == "assistant") & (i > 1),
        F.concat(F.lit("step "), m["content"]),
    )
    return df.withColumn(
        "messages",
        F.transform(
            "messages",
            lambda m, i: F.struct(
                m["role"].alias("role"), m["content"].alias("content"),
                think(m, i).alias("reasoning_content"), m["tool_calls"].alias("tool_calls"),
            ),
        ),
    )


# One row per turn with its position and the position of the last user turn.
TURNS = """
t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations),
x AS (SELECT *, max(CASE WHEN role = 'user' THEN i END) OVER (PARTITION BY conv_id) AS last_user,
             max(i) OVER (PARTITION BY conv_id) AS last_i,
             CASE WHEN conv_id % 3 = 0 AND role = 'assistant' AND i > 1 THEN 'step ' || text END AS reason,
             lead(role) OVER (PARTITION BY conv_id ORDER BY i) AS next_role,
             lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS prev_role FROM t)"""
SYSTEM = "'<|im_start|>system' || chr(10)"
ENDS = "'<|im_end|>' || chr(10)"


def seg_sql(body):
    """Rendered text of one turn."""
    turn = f"'<|im_start|>' || role || chr(10) || CASE WHEN role = 'assistant' THEN {body} ELSE text END || {ENDS}"
    return f"""CASE WHEN i = 0 AND role = 'system' THEN {SYSTEM} || text || {ENDS}
               WHEN i = 0 THEN {SYSTEM} || {ENDS} || {turn} ELSE {turn} END"""


PLAIN = seg_sql(strip_sql("('<think></think>' || text)"))
THINK = seg_sql(
    f"""(CASE WHEN reason IS NOT NULL AND i >= last_user THEN {strip_sql("('<think>' || chr(10) || reason || chr(10) || '</think>' || chr(10) || text)")}
         WHEN reason IS NOT NULL THEN {strip_sql("('<think></think>' || chr(10) || text)")}
         ELSE {strip_sql("('<think></think>' || text)")} END)"""
)


@CATALOG.add(
    "render_chat",
    f"WITH {TURNS} SELECT conv_id, string_agg({PLAIN}, '' ORDER BY i) AS rendered FROM x GROUP BY conv_id",
)
def _(spark, folder):
    return chat.render_chat(chat.full_messages(chats(spark, folder))).select("conv_id", "rendered")


@CATALOG.add(
    "render_chat_thinking",
    f"WITH {TURNS} SELECT conv_id, string_agg({THINK}, '' ORDER BY i) AS rendered FROM x GROUP BY conv_id",
)
def _(spark, folder):
    return chat.render_chat(thinking_chats(spark, folder)).select("conv_id", "rendered")


TOOLS = (
    '[{"type": "function", "function": {"name": "lookup", "description": " Find it. ", "strict": true, "parameters": {"type": "object", '
    '"properties": {"key": {"type": "string", "description": "a key ", "enum": ["x", "y"], "default": 1}, "n": {"type": ["integer", "null"]}}, '
    '"required": ["key"], "additionalProperties": false}}}]'
)
TOOLS_TEXT = chat.TOOLS_INTRO + """
<function>
<name>lookup</name>
<description>Find it.</description>
<parameters>
<parameter>
<name>key</name>
<type>string</type>
<description>a key</description>
<enum>["x", "y"]</enum>
<default>1</default>
</parameter>
<parameter>
<name>n</name>
<type>['integer', 'null']</type>
</parameter>
<additionalProperties>False</additionalProperties>
<required>["key"]</required>
</parameters>
<strict>True</strict>
</function>""" + chat.TOOLS_OUTRO
TOOLS_SQL = "CASE WHEN conv_id % 2 = 0 THEN '" + TOOLS_TEXT.replace("'", "''") + "' ELSE '' END"
WITH_TOOLS = PLAIN.replace(
    f"{SYSTEM} || text || {ENDS}", f"{SYSTEM} || text || CASE WHEN conv_id % 2 = 0 AND text <> '' THEN chr(10) || chr(10) ELSE '' END || {TOOLS_SQL} || {ENDS}"
).replace(f"{SYSTEM} || {ENDS}", f"{SYSTEM} || {TOOLS_SQL} || {ENDS}")


@CATALOG.add(
    "render_json_tools",
    f"WITH {TURNS} SELECT conv_id, string_agg({WITH_TOOLS}, '' ORDER BY i) AS rendered FROM x GROUP BY conv_id",
)
def _(spark, folder):
    """Tool schemas as free JSON in every second conversation; the others have an empty list."""
    df = chat.full_messages(chats(spark, folder))
    df = df.withColumn("tools", F.when(F.col("conv_id") % 2 == 0, TOOLS).otherwise("[]"))
    return chat.render_chat(df, tools="tools").select("conv_id", "rendered")


DROPPED = """
bad AS (SELECT conv_id, bool_or(i = last_i AND role = 'user') OR bool_or(role = 'user' AND next_role IS NOT NULL AND next_role <> 'assistant')
        OR bool_or(role = 'assistant' AND (text LIKE '%<think>%' OR text LIKE '%</think>%')) AS droppable FROM x GROUP BY conv_id)"""
PROMPT = "'<|im_start|>assistant' || chr(10) || '<think></think>'"
CHUNKS = f"""{TURNS}, {DROPPED},
c AS (SELECT conv_id, i, role, CASE WHEN prev_role = 'user' THEN substr({PLAIN}, length({PROMPT}) + 1) ELSE {PLAIN} END
        || CASE WHEN role = 'user' THEN {PROMPT} ELSE '' END AS content
      FROM x JOIN bad USING (conv_id) WHERE NOT droppable)"""


def kept(spark, folder):
    df = chat.droppable(chat.expand_turns(chat.full_messages(chats(spark, folder))))
    return df.filter("not droppable").drop("droppable")


@CATALOG.add("droppable_conversations", f"WITH {TURNS}, {DROPPED} SELECT conv_id, droppable FROM bad")
def _(spark, folder):
    df = chat.expand_turns(chat.full_messages(chats(spark, folder)))
    return chat.droppable(df).select("conv_id", "droppable")


@CATALOG.add("role_chunks", f"WITH {CHUNKS} SELECT conv_id, i AS pos, role, content FROM c")
def _(spark, folder):
    df = chat.role_chunks(kept(spark, folder))
    return df.select("conv_id", F.posexplode_outer("chunks").alias("pos", "c")).select(
        "conv_id", F.col("pos").cast("bigint").alias("pos"), "c.role", "c.content"
    )


SPLIT = f"""{CHUNKS},
s AS (SELECT conv_id, i * 2 AS i, role, CASE WHEN i = 0 AND role = 'user'
        THEN substr(content, instr(content, '<|im_start|>user')) ELSE content END AS content FROM c
      UNION ALL SELECT conv_id, -1, 'system', substr(content, 1, instr(content, {ENDS}) + 10) FROM c WHERE i = 0 AND role = 'user')"""


@CATALOG.add(
    "split_system_user",
    f"WITH {SPLIT} SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1 AS pos, role, content FROM s",
)
def _(spark, folder):
    df = chat.split_system_user(chat.role_chunks(kept(spark, folder)))
    return df.select("conv_id", F.posexplode_outer("chunks").alias("pos", "c")).select(
        "conv_id", F.col("pos").cast("bigint").alias("pos"), "c.role", "c.content"
    )


@CATALOG.add(
    "expand_turns",
    f"""
    WITH {TURNS}, th AS (SELECT conv_id, bool_or(reason IS NOT NULL) AS thinking, max(i) + 1 AS n FROM x GROUP BY conv_id),
    u AS (SELECT conv_id, i, row_number() OVER w - 1 AS part, lead(i) OVER w AS nxt FROM x WHERE role = 'user'
          WINDOW w AS (PARTITION BY conv_id ORDER BY i))
    SELECT conv_id, thinking, 0 AS part, n FROM th WHERE NOT thinking
    UNION ALL SELECT conv_id, thinking, part, coalesce(nxt, n) FROM u JOIN th USING (conv_id) WHERE thinking""",
)
def _(spark, folder):
    df = chat.expand_turns(thinking_chats(spark, folder))
    return df.select(
        "conv_id", "thinking", F.col("part").cast("bigint").alias("part"), F.size("messages").cast("bigint").alias("n")
    )


@CATALOG.add(
    "thinking_chunks",
    f"""
    WITH {TURNS}, th AS (SELECT conv_id, max(i) AS last_i FROM x GROUP BY conv_id HAVING bool_or(reason IS NOT NULL)),
    u AS (SELECT conv_id, i, row_number() OVER w - 1 AS part, coalesce(lead(i) OVER w, last_i + 1) AS stop FROM x JOIN th USING (conv_id, last_i)
          WHERE role = 'user' WINDOW w AS (PARTITION BY conv_id ORDER BY i))
    SELECT conv_id, part, stop - i + 1 AS n, true AS same FROM u WHERE stop > i + 1""",
)
def _(spark, folder):
    """Chunks of reasoning conversations; their join must equal the rendered text."""
    df = chat.droppable(chat.expand_turns(thinking_chats(spark, folder))).filter("not droppable and thinking")
    both = chat.role_chunks(chat.render_chat(df))
    text = F.array_join("chunks.content", "")
    return both.select("conv_id", "part", F.size("chunks").cast("bigint").alias("n"), (text == F.col("rendered")).alias("same"))


# The whole arrays of every conversation.
CONTENT_TOKENS = TOKENS.replace("(text", "(content")
ARRAYS = f"""{SPLIT},
a AS (SELECT conv_id, flatten(list(ids ORDER BY i)) AS ids, flatten(list(mask ORDER BY i)) AS mask FROM (
  SELECT conv_id, i, list_transform({CONTENT_TOKENS}, lambda t: {hash_sql("t")} % 50000 + 3) AS ids,
    list_transform({CONTENT_TOKENS}, lambda t: CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS mask FROM s) GROUP BY conv_id)"""


def digest(column):
    """md5 of all entries of an array, in order."""
    return F.md5(F.array_join(F.col(column).cast("array<string>"), ","))


def digest_sql(column):
    return f"md5(array_to_string({column}, ','))"


@CATALOG.add(
    "loss_mask",
    f"""WITH {ARRAYS} SELECT conv_id, len(ids) AS n_tokens, list_sum(mask)::BIGINT AS n_loss,
      {digest_sql("ids")} AS ids_md5, {digest_sql("mask")} AS mask_md5 FROM a""",
)
def _(spark, folder):
    df = chat.chat_sequences(chats(spark, folder))
    return df.select(
        "conv_id",
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        F.aggregate("loss_mask", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("n_loss"),
        digest("input_ids").alias("ids_md5"), digest("loss_mask").alias("mask_md5"),
    )



@CATALOG.add(
    "align_mask",
    "WITH m AS (SELECT conv_id, turn, lead(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END, 1, 0)"
    " OVER (PARTITION BY conv_id ORDER BY turn) AS v FROM conversations)"
    " SELECT conv_id, string_agg(v::VARCHAR, ',' ORDER BY turn) AS mask FROM m GROUP BY conv_id",
)
def _(spark, folder):
    mask = F.transform("messages", lambda m: (m["role"] == "assistant").cast("int"))
    df = chats(spark, folder).withColumn("m", mask)
    return df.select("conv_id", F.array_join(packing.align_mask("m").cast("array<string>"), ",").alias("mask"))


@CATALOG.add(
    "clamp_lengths",
    "SELECT l_orderkey, l_linenumber, least(l_quantity, 30) AS length, l_quantity > 30 AS clamped FROM lineitem",
)
def _(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("length"))
    return packing.clamp(df, 30)


def tool_chats(spark, folder):
    """Tool-call argument strings: one per assistant turn, broken on every seventh conversation."""
    arguments = F.when(F.col("conv_id") % 7 == 0, '{"q": ').otherwise('{"q": "x", "n": 2}')
    call = F.array(F.struct(F.lit("find").alias("name"), arguments.alias("arguments")))
    return chats(spark, folder).withColumn(
        "messages",
        F.transform(
            "messages",
            lambda m: F.struct(
                m["role"].alias("role"), m["content"].alias("content"),
                F.when(m["role"] == "assistant", call).alias("tool_calls"),
            ),
        ),
    )


@CATALOG.add(
    "parse_tool_args",
    """SELECT conv_id, conv_id % 7 = 0 AND bool_or(role = 'assistant') AS bad,
       CASE WHEN conv_id % 7 <> 0 THEN nullif(count(*) FILTER (role = 'assistant'), 0) END AS n_maps FROM conversations GROUP BY conv_id""",
)
def _(spark, folder):
    df = chat.parse_tool_args(tool_chats(spark, folder))
    maps = F.filter(F.flatten(F.transform("messages", lambda m: F.coalesce(m["tool_calls"], F.array()))),
                    lambda c: F.coalesce(F.size(c["arguments"]) == 2, F.lit(False)))
    n = F.size(maps).cast("bigint")
    return df.select("conv_id", F.col("bad_tool_args").alias("bad"), F.when(n > 0, n).alias("n_maps"))


@CATALOG.add(
    "render_tool_calls",
    f"""WITH {TURNS}, r AS (SELECT conv_id, i, CASE WHEN role = 'assistant' THEN
        '<|im_start|>assistant' || chr(10) || {strip_sql("('<think></think>' || text)")} || chr(10) || '<tool_call>' || chr(10)
        || '<function=find>' || chr(10) || '<parameter=q>' || chr(10) || 'x' || chr(10) || '</parameter>' || chr(10)
        || '<parameter=n>' || chr(10) || '2' || chr(10) || '</parameter>' || chr(10) || '</function>' || chr(10)
        || '</tool_call>' || chr(10) || {ENDS} ELSE {PLAIN} END AS s FROM x)
    SELECT conv_id, string_agg(s, '' ORDER BY i) AS rendered FROM r WHERE conv_id % 7 <> 0 GROUP BY conv_id""",
)
def _(spark, folder):
    parsed = chat.parse_tool_args(tool_chats(spark, folder)).filter("not bad_tool_args").filter("conv_id % 7 <> 0")
    return chat.render_chat(chat.full_messages(parsed)).select("conv_id", "rendered")


@CATALOG.add(
    "chat_truncation",
    f"""WITH {ARRAYS} SELECT conv_id, least(len(ids), 64) AS n, coalesce(list_sum(mask[1:64]), 0)::BIGINT AS trained,
      {digest_sql("ids[1:64]")} AS ids_md5, {digest_sql("mask[1:64]")} AS mask_md5 FROM a""",
)
def _(spark, folder):
    """Conversations cut to 64 tokens, and the trained tokens among them."""
    out = chat.chat_sequences(chats(spark, folder), max_tokens=64)
    trained = F.aggregate("loss_mask", F.lit(0).cast("bigint"), lambda s, m: s + m)
    return out.select(
        "conv_id", F.size("input_ids").cast("bigint").alias("n"), trained.alias("trained"),
        digest("input_ids").alias("ids_md5"), digest("loss_mask").alias("mask_md5"),
    )


# --- packing -----------------------------------------------------------------


def lengths(spark, folder):
    """Conversations as sequences: length in tokens, four shards."""
    from quarry.functions.columns import token_count

    c = table(spark, folder, "conversations")
    return c.groupBy("conv_id").agg(F.sum(token_count("text")).alias("length")).select(
        (F.col("conv_id") % 4).cast("int").alias("shard"), F.col("conv_id").alias("seq_id"), F.col("length").cast("int").alias("length")
    )


# Every shard is packed in two parts.
PARTS = 2
PART = f"(('0x' || substr(md5(conv_id::VARCHAR), 1, 15))::BIGINT % {PARTS})::INTEGER AS part"
NEXT_FIT = f"""
q AS (SELECT (conv_id % 4)::INTEGER AS shard, {PART}, conv_id AS seq_id, least(sum({token_count_sql()}), 512)::BIGINT AS length
      FROM conversations GROUP BY conv_id),
o AS (SELECT *, row_number() OVER (PARTITION BY shard, part ORDER BY seq_id) AS i FROM q),
walk(shard, part, seq_id, length, i, bin_id, used) AS (
  SELECT shard, part, seq_id, length, i, 0::BIGINT, length FROM o WHERE i = 1
  UNION ALL
  SELECT o.shard, o.part, o.seq_id, o.length, o.i, CASE WHEN w.used + o.length > 512 THEN w.bin_id + 1 ELSE w.bin_id END,
         CASE WHEN w.used + o.length > 512 THEN o.length ELSE w.used + o.length END
  FROM walk w JOIN o ON o.shard = w.shard AND o.part = w.part AND o.i = w.i + 1),
bins AS (SELECT shard, part, bin_id, seq_id, length, row_number() OVER (PARTITION BY shard, part, bin_id ORDER BY i) - 1 AS pos FROM walk)"""


@CATALOG.add("pack_concatenative", f"WITH RECURSIVE {NEXT_FIT} SELECT shard, part, bin_id, pos, seq_id, length FROM bins")
def _(spark, folder):
    return packing.pack(lengths(spark, folder), 512, "concatenative", parts=PARTS)


FIRST_FIT = f"""
q AS (SELECT (conv_id % 4)::INTEGER AS shard, {PART}, conv_id AS seq_id, least(sum({token_count_sql()}), 512)::BIGINT AS length
      FROM conversations GROUP BY conv_id),
o AS (SELECT *, row_number() OVER (PARTITION BY shard, part ORDER BY length DESC, seq_id) AS i FROM q),
walk(shard, part, seq_id, length, i, bin_id, room) AS (
  SELECT shard, part, seq_id, length, i, 0::BIGINT, [512 - length] FROM o WHERE i = 1
  UNION ALL
  SELECT shard, part, seq_id, length, i, coalesce(b, len(room) + 1) - 1,
         CASE WHEN b IS NULL THEN list_append(room, 512 - length)
              ELSE list_transform(room, lambda r, k: CASE WHEN k = b THEN r - length ELSE r END) END
  FROM (SELECT o.shard, o.part, o.seq_id, o.length, o.i, w.room,
               list_position(list_transform(w.room, lambda r: r >= o.length), true) AS b
        FROM walk w JOIN o ON o.shard = w.shard AND o.part = w.part AND o.i = w.i + 1))"""


@CATALOG.add(
    "pack_first_fit_decreasing",
    f"""WITH RECURSIVE {FIRST_FIT} SELECT shard, part, bin_id, seq_id, length,
        row_number() OVER (PARTITION BY shard, part, bin_id ORDER BY i) - 1 AS pos FROM walk""",
)
def _(spark, folder):
    return packing.pack(lengths(spark, folder), 512, "first_fit_decreasing", parts=PARTS)


@CATALOG.add(
    "pack_first_fit_shuffle_check",
    f"""WITH q AS (SELECT (conv_id % 4)::INTEGER AS shard, {PART}, conv_id AS seq_id, least(sum({token_count_sql()}), 512)::BIGINT AS length
      FROM conversations GROUP BY conv_id)
    SELECT shard, part, count(*) AS sequences, sum(length)::BIGINT AS tokens, md5(string_agg(seq_id::VARCHAR, ',' ORDER BY seq_id)) AS ids_md5,
      0::BIGINT AS too_full, true AS at_most_one_half_full, true AS in_order FROM q GROUP BY ALL""",
)
def _(spark, folder):
    """What holds for any first-fit packing: every sequence once, no bin too full, at most one bin no more than half full."""
    out = packing.pack(lengths(spark, folder), 512, "first_fit_shuffle", seed=42, parts=PARTS)
    bins = out.groupBy("shard", "part", "bin_id").agg(
        F.count("*").alias("n"), F.sum("length").alias("t"), F.collect_list("seq_id").alias("ids"), F.max("pos").alias("last"),
    )
    return bins.groupBy("shard", "part").agg(
        F.sum("n").alias("sequences"), F.sum("t").alias("tokens"),
        F.md5(F.array_join(F.sort_array(F.flatten(F.collect_list("ids"))).cast("array<string>"), ",")).alias("ids_md5"),
        F.count_if(F.col("t") > 512).alias("too_full"), (F.count_if(2 * F.col("t") <= 512) <= 1).alias("at_most_one_half_full"),
        (F.max("bin_id") + 1 == F.count("*")).alias("in_order"),
    )


@CATALOG.add("pack_first_fit_shuffle")
def _(spark, folder):
    return packing.pack(lengths(spark, folder), 512, "first_fit_shuffle", seed=42, parts=PARTS)


@CATALOG.add(
    "packing_metrics",
    f"""
    WITH RECURSIVE {NEXT_FIT} SELECT count(*) AS num_sequences, count(DISTINCT (shard, part, bin_id)) AS num_bins,
      sum(length)::BIGINT AS total_tokens, round(count(*)::DOUBLE / count(DISTINCT (shard, part, bin_id)), 2) AS packing_factor,
      round(sum(length)::DOUBLE / (count(DISTINCT (shard, part, bin_id)) * 512) * 100, 1) AS packing_efficiency FROM bins""",
)
def _(spark, folder):
    return packing.packing_metrics(packing.pack(lengths(spark, folder), 512, "concatenative", parts=PARTS), 512)


def packed(spark, folder):
    """Whole conversations, raw role-text tokens, packed next-fit into bins of 512."""
    seqs = chat.chat_sequences(chats(spark, folder)).select(
        (F.col("conv_id") % 4).cast("int").alias("shard"), F.col("conv_id").alias("seq_id"),
        "input_ids", "loss_mask", F.size("input_ids").alias("length"),
    )
    return packing.materialize_bins(seqs, packing.pack(seqs, 512, "concatenative", parts=PARTS), 512)


PACKED = f"""
{ARRAYS},
q AS (SELECT (conv_id % 4)::INTEGER AS shard, {PART}, conv_id AS seq_id, least(sum({token_count_sql("content")}), 512)::BIGINT AS length
      FROM s GROUP BY conv_id)""" + NEXT_FIT[NEXT_FIT.index(",\no AS"):] + """,
st AS (SELECT *, sum(length) OVER (PARTITION BY shard, part, bin_id ORDER BY pos) - length AS start FROM bins),
full_bins AS (SELECT shard, part, bin_id, sum(length)::BIGINT AS n, string_agg(start::BIGINT::VARCHAR, ',' ORDER BY pos) AS starts,
  md5(string_agg(array_to_string(ids[1:512], ','), ',' ORDER BY pos)) AS ids_md5,
  md5(string_agg(array_to_string(list_append(mask[2:512], 0), ','), ',' ORDER BY pos)) AS mask_md5
  FROM st JOIN a ON a.conv_id = st.seq_id WHERE length > 0 GROUP BY ALL)"""


def whole_bins(bins):
    return bins.select(
        "shard", "part", "bin_id", F.size("input_ids").cast("bigint").alias("n"),
        F.array_join(F.col("seq_start_id").cast("array<string>"), ",").alias("starts"),
        digest("input_ids").alias("ids_md5"), digest("loss_mask").alias("mask_md5"),
    )


@CATALOG.add("materialize_bins", f"WITH RECURSIVE {PACKED} SELECT * FROM full_bins")
def _(spark, folder):
    return whole_bins(packed(spark, folder))


@CATALOG.add(
    "unknown_sequences",
    "SELECT (conv_id % 4)::INTEGER AS shard, conv_id AS seq_id FROM conversations WHERE conv_id % 10 = 3 GROUP BY conv_id",
)
def _(spark, folder):
    """Every tenth sequence is taken away from the data but left in the assignment."""
    seqs = lengths(spark, folder)
    assigned = packing.pack(seqs, 512, "concatenative")
    return packing.unknown_sequences(seqs.filter("seq_id % 10 <> 3"), assigned).select("shard", "seq_id")


@CATALOG.add(
    "pack_metadata",
    f"""WITH RECURSIVE {PACKED}, b AS (SELECT shard, part, bin_id, count(*) AS n, sum(length)::BIGINT AS t, max(length) AS longest FROM st GROUP BY ALL)
    SELECT max(n) AS max_samples_per_bin, max(longest)::BIGINT AS dataset_max_seqlen, min(t) AS min_packed_seqlen,
      round(avg(n), 2) AS packing_factor, round(sum(t)::DOUBLE / (count(*) * 512) * 100, 1) AS packing_efficiency,
      512::BIGINT AS pack_size FROM b""",
)
def _(spark, folder):
    return packing.pack_metadata(packed(spark, folder), 512)
