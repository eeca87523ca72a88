"""Chat template, role chunks, turn expansion and loss masks over message arrays.

Messages: array<struct<role, content[, reasoning_content, tool_calls]>> with
tool_calls: array<struct<name, arguments: map<string,string>>>. Everything is a
column expression on the row, so nothing is shuffled.
"""

import json

import pandas as pd
from pyspark.sql import functions as F, types as T

from quarry.functions.columns import strip, token_ids
from quarry.plans.once import compute_once

# Markers of the chat format and the tool instructions.
START, END = "<|im_start|>", "<|im_end|>\n"
OPEN, CLOSE, NO_THOUGHT = "<think>", "</think>", "<think></think>"
TOOLS_INTRO = "# Tools\n\nYou have access to the following functions:\n\n<tools>"
TOOLS_OUTRO = """
</tools>

If you choose to call a function ONLY reply in the following format with NO suffix:

<tool_call>
<function=example_function_name>
<parameter=example_parameter_1>
value_1
</parameter>
<parameter=example_parameter_2>
This is the value for the second parameter
that can span
multiple lines
</parameter>
</function>
</tool_call>

<IMPORTANT>
Reminder:
- Function calls MUST follow the specified format: an inner <function=...></function> block must be nested within <tool_call></tool_call> XML tags
- Required parameters MUST be specified
- You may provide optional reasoning for your function call in natural language BEFORE the function call, but NOT after
- If there is no function call available, answer the question like normal with your current knowledge and do not tell the user about function calls
</IMPORTANT>"""

MESSAGE = (
    "array<struct<role:string,content:string,reasoning_content:string,"
    "tool_calls:array<struct<name:string,arguments:map<string,string>>>>>"
)


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def full_messages(df, messages="messages"):
    """Add the optional message fields as nulls, so that one schema holds."""
    fields = df.schema[messages].dataType.elementType.fieldNames()
    tools = "array<struct<name:string,arguments:map<string,string>>>"

    def widen(m):
        reasoning = m["reasoning_content"] if "reasoning_content" in fields else F.lit(None)
        calls = m["tool_calls"] if "tool_calls" in fields else F.lit(None)
        return F.struct(
            m["role"].alias("role"),
            m["content"].alias("content"),
            reasoning.cast("string").alias("reasoning_content"),
            calls.cast(tools).alias("tool_calls"),
        )

    return df.withColumn(messages, F.transform(messages, widen))


def parse_tool_args(df, messages="messages", flag="bad_tool_args"):
    """JSON argument strings of assistant tool calls to maps; `flag` marks records
    with an argument string that is not a JSON object."""

    def calls(m):
        parse = lambda c: F.struct(
            c["name"].alias("name"),
            F.from_json(c["arguments"], "map<string,string>").alias("arguments"),
        )
        return F.when(m["role"] == "assistant", F.transform(m["tool_calls"], parse))

    def broken(m):
        bad = lambda c: c["arguments"].isNotNull() & F.try_parse_json(c["arguments"]).isNull()
        return (m["role"] == "assistant") & F.coalesce(F.exists(m["tool_calls"], bad), F.lit(False))

    fields = [f for f in df.schema[messages].dataType.elementType.fieldNames() if f != "tool_calls"]
    parsed = F.transform(
        messages, lambda m: F.struct(*[m[f].alias(f) for f in fields], calls(m).alias("tool_calls"))
    )
    return df.withColumns({flag: F.exists(messages, broken), messages: parsed})


def _has(c, marker):
    return F.contains(c, F.lit(marker))


def _reasoned(m):
    return F.coalesce(F.length(strip(m["reasoning_content"])) > 0, F.lit(False))


def _assistant_body(m):
    """Content with its thinking part in front."""
    content = F.coalesce(m["content"], F.lit(""))
    plain = F.when(_has(content, OPEN) | _has(content, CLOSE), content).otherwise(_text(NO_THOUGHT, content))
    return F.when(_reasoned(m), _text(OPEN + "\n", m["reasoning_content"], "\n" + CLOSE + "\n", content)).otherwise(plain)


def _assistant(m, history):
    """One assistant message. In the history the thinking part is emptied."""
    body = _assistant_body(m)
    last = F.substring_index(body, CLOSE, -1)
    old_plain = strip(F.when(_has(body, OPEN) & _has(body, CLOSE), _text(NO_THOUGHT, last)).otherwise(body))
    old_call = _text(
        NO_THOUGHT,
        strip(
            F.when(_has(body, CLOSE), last)
            .when(_has(body, OPEN), F.substring_index(body, OPEN, 1))
            .otherwise(body)
        ),
    )
    plain = F.when(history, old_plain).otherwise(strip(body))
    with_call = F.when(history, old_call).otherwise(strip(body))

    def argument(e):
        return _text("<parameter=", e["key"], ">\n", F.coalesce(e["value"], F.lit("None")), "\n</parameter>\n")

    def call(c):
        arguments = F.transform(F.map_entries(c["arguments"]), argument)
        return _text(
            "<tool_call>\n<function=", c["name"], ">\n",
            F.coalesce(F.array_join(arguments, ""), F.lit("")),
            "</function>\n</tool_call>\n",
        )

    has_calls = F.coalesce(F.size(m["tool_calls"]) > 0, F.lit(False))
    calls = F.array_join(F.transform(m["tool_calls"], call), "")
    return F.when(has_calls, _text(START + "assistant\n", with_call, "\n", calls, END)).otherwise(
        _text(START + "assistant\n", plain, END)
    )


def _other(m, before, after, first):
    """User, system and tool messages. A run of tool results is one user turn."""
    opens = F.when(~first & (before["role"] != "tool"), START + "user\n").otherwise("")
    closes = F.when(after.isNull() | (after["role"] != "tool"), END).otherwise("")
    result = _text(opens, "<tool_response>\n", m["content"], "\n</tool_response>\n", closes)
    return F.when(m["role"] == "tool", result).otherwise(_text(START, m["role"], "\n", m["content"], END))


def tools_block(tools):
    """`# Tools` block from array<struct<name, description, parameters_xml>>.

    `parameters_xml` is the inside of `<parameters>`, see `tool_parameters`.
    """

    def one(t):
        described = F.when(
            t["description"].isNotNull(), _text("\n<description>", strip(t["description"]), "</description>")
        ).otherwise("")
        return _text(
            "\n<function>\n<name>", t["name"], "</name>", described, "\n<parameters>",
            F.coalesce(t["parameters_xml"], F.lit("")), "\n</parameters>\n</function>",
        )

    return _text(TOOLS_INTRO, F.array_join(F.transform(tools, one), ""), TOOLS_OUTRO)


def tool_parameters(properties, required):
    """XML for array<struct<name, type, description, enum>> and a list of required names.

    Enum and required lists are arrays of strings and are written as JSON.
    """
    optional = lambda tag, v: F.when(v.isNotNull(), _text(f"\n<{tag}>", v, f"</{tag}>")).otherwise("")
    as_list = lambda a: _text(
        "[", F.array_join(F.transform(a, lambda v: _text('"', v, '"')), ", "), "]"
    )

    def one(p):
        return _text(
            "\n<parameter>\n<name>", p["name"], "</name>",
            optional("type", p["type"]),
            optional("description", strip(p["description"])),
            optional("enum", F.when(p["enum"].isNotNull(), as_list(p["enum"]))),
            "\n</parameter>",
        )

    listed = F.coalesce(F.array_join(F.transform(properties, one), ""), F.lit(""))
    return F.concat(listed, optional("required", F.when(F.col(required).isNotNull(), as_list(F.col(required)))))


def as_text(value):
    """Lists and objects as JSON, everything else as its plain text."""
    return json.dumps(value, ensure_ascii=False) if isinstance(value, (dict, list)) else str(value)


def tagged(fields, skip):
    """One tag per field that is not in `skip`, on a line of its own."""
    if not isinstance(fields, dict):
        return ""
    return "".join(f"\n<{key}>{as_text(value)}</{key}>" for key, value in fields.items() if key not in skip)


def function_text(tool):
    """The entry of one tool schema: known fields in their order, then whatever else it has."""
    tool = tool.get("function", tool)
    schema = tool.get("parameters")
    given = schema if isinstance(schema, dict) else {}
    properties = given["properties"] if isinstance(given.get("properties"), dict) else {}
    lines = [f"\n<function>\n<name>{tool.get('name', '')}</name>"]
    if "description" in tool:
        lines.append(f"\n<description>{str(tool['description']).strip()}</description>")
    lines.append("\n<parameters>")
    for name, field in properties.items():
        field = field if isinstance(field, dict) else {}
        known = {k: field[k].strip() if k == "description" else field[k] for k in ("type", "description") if k in field}
        lines += [f"\n<parameter>\n<name>{name}</name>", "".join(f"\n<{k}>{v}</{k}>" for k, v in known.items())]
        if "enum" in field:
            lines.append(f"\n<enum>{json.dumps(field['enum'], ensure_ascii=False)}</enum>")
        lines += [tagged(field, ("name", "type", "description", "enum")), "\n</parameter>"]
    lines.append(tagged(schema, ("type", "properties", "required")))
    if "required" in given:
        lines.append(f"\n<required>{json.dumps(given['required'], ensure_ascii=False)}</required>")
    lines += ["\n</parameters>", tagged(tool, ("type", "name", "description", "parameters")), "\n</function>"]
    return "".join(lines)


@F.pandas_udf(T.StringType())
def json_tools_block(tools: pd.Series) -> pd.Series:
    """`# Tools` block from a JSON list of tool schemas; '' for null, an empty list, or no list."""

    def one(text):
        try:
            found = json.loads(text) if text else []
        except ValueError:
            found = []
        listed = [t for t in found if isinstance(t, dict)] if isinstance(found, list) else []
        return TOOLS_INTRO + "".join(map(function_text, listed)) + TOOLS_OUTRO if listed else ""

    return tools.map(one)


def segments(df, messages="messages", tools=None, out="segments"):
    """Add rendered text per message. The system block comes first and is always
    there; without a leading system message it is part of the first segment.

    `tools` names a column of typed tools (see `tools_block`) or of JSON lists of schemas."""
    leads = F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))
    df = df.withColumns(
        {
            "_leads": leads,
            "_last_user": F.coalesce(
                F.array_max(
                    F.filter(
                        F.transform(messages, lambda m, i: F.when(m["role"] == "user", i)),
                        lambda i: i.isNotNull(),
                    )
                ),
                F.lit(-1),
            ),
        }
    )
    system = F.when(F.col("_leads"), F.coalesce(F.get(messages, F.lit(0))["content"], F.lit(""))).otherwise("")
    if tools is not None:
        gap = F.when(F.length(system) > 0, "\n\n").otherwise("")
        if df.select(tools).dtypes[0][1] == "string":
            df = compute_once(df, _tools=json_tools_block(tools))
            some, block = F.length("_tools") > 0, F.col("_tools")
        else:
            some, block = F.coalesce(F.size(tools) > 0, F.lit(False)), tools_block(tools)
        system = F.concat(system, F.when(some, F.concat(gap, block)).otherwise(""))
    df = df.withColumn("_system", _text(START + "system\n", system, END))

    def render(m, i):
        before = F.get(messages, i - 1)
        after = F.get(messages, i + 1)
        first = i == F.when(F.col("_leads"), 1).otherwise(0)
        text = F.when(m["role"] == "assistant", _assistant(m, i < F.col("_last_user"))).otherwise(
            _other(m, before, after, first)
        )
        return (
            F.when((i == 0) & F.col("_leads"), F.col("_system"))
            .when(i == 0, F.concat(F.col("_system"), text))
            .otherwise(text)
        )

    return df.withColumn(out, F.transform(messages, render))


def render_chat(df, messages="messages", tools=None, out="rendered", generation_prompt=None):
    """The whole conversation as one string; `generation_prompt` is None, "think" or "plain"."""
    tail = {None: "", "think": START + "assistant\n<think>\n", "plain": START + "assistant\n" + NO_THOUGHT}
    done = segments(df, messages, tools)
    return done.withColumn(out, F.concat(F.array_join("segments", ""), F.lit(tail[generation_prompt]))).drop(
        "segments", "_leads", "_last_user", "_system", "_tools"
    )


def has_thinking(messages="messages"):
    return F.exists(messages, lambda m: F.coalesce(F.length(m["reasoning_content"]) > 0, F.lit(False)))


def expand_turns(df, messages="messages"):
    """With any reasoning: one row per user turn, holding the messages before the
    next user turn. Without: the conversation as it is. Adds `thinking` and `part`."""
    marked = df.withColumn("thinking", has_thinking(messages))
    n = F.size(messages)
    users = F.filter(
        F.transform(messages, lambda m, i: F.when(m["role"] == "user", i)), lambda i: i.isNotNull()
    )
    ends = F.transform(users, lambda u, i: F.coalesce(F.get(users, i + 1), n))
    rows = marked.withColumn("_ends", F.when(F.col("thinking"), ends).otherwise(F.array(n)))
    # The outer form keeps Spark from pushing a copy of the computed array into a filter.
    exploded = rows.select("*", F.posexplode_outer("_ends").alias("part", "_end")).filter("part is not null")
    return exploded.withColumn(messages, F.slice(messages, F.lit(1), F.col("_end"))).drop("_ends", "_end")


def _prompt(m, after, thinking):
    """Generation prompt that ends the chunk of message `m`, or an empty string."""
    empty = ~F.coalesce(F.length(after["reasoning_content"]) > 0, F.lit(False))
    plain, think = START + "assistant\n" + NO_THOUGHT, START + "assistant\n<think>\n"
    asks = m["role"].isin("user", "tool")
    return (
        F.when(thinking & (m["role"] != "assistant") & after.isNotNull() & empty, plain)
        .when(asks & thinking, think)
        .when(asks, plain)
        .otherwise("")
    )


def droppable(df, messages="messages", out="droppable"):
    """Mark conversations that cannot be cut into chunks (after `expand_turns`):
    a user or tool turn that is not answered by the assistant, thinking without a
    user turn, or old assistant text with think tags of its own."""
    last = F.element_at(messages, -1)["role"]
    pairs = F.zip_with(
        F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0))),
        F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0))),
        lambda a, b: (
            a["role"].isin("user", "tool")
            & (b["role"] != "assistant")
            & ~((a["role"] == "tool") & (b["role"] == "tool"))
        ),
    )
    users = F.exists(messages, lambda m: m["role"] == "user")
    tags = F.exists(
        messages,
        lambda m: (m["role"] == "assistant")
        & (_has(F.coalesce(m["content"], F.lit("")), OPEN) | _has(F.coalesce(m["content"], F.lit("")), CLOSE)),
    )
    return df.withColumn(
        out,
        (F.size(messages) == 0)
        | last.isin("user", "tool")
        | F.exists(pairs, lambda p: p)
        | (F.col("thinking") & ~users)
        | tags,
    )


def role_chunks(df, messages="messages", tools=None, out="chunks"):
    """Add the rendered text cut per message: array<struct<role, content>>.

    Expects `expand_turns` columns and no droppable rows. A run of tool results is
    one chunk, and the generation prompt belongs to the user or tool chunk before
    it. A thinking row starts with a system chunk and a user chunk that holds the
    history up to the last user turn.
    """
    done = segments(df, messages, tools)
    done = done.withColumn(
        "_prompts",
        F.transform(messages, lambda m, i: _prompt(m, F.get(messages, i + 1), F.col("thinking"))),
    )
    joins_next = lambda m, i: (m["role"] == "tool") & F.coalesce(
        F.get(messages, i + 1)["role"] == "tool", F.lit(False)
    )
    done = done.withColumn(
        "_ends",
        F.filter(
            F.transform(
                messages,
                lambda m, i: F.when(
                    ~joins_next(m, i) & (~F.col("thinking") | (i >= F.col("_last_user"))), i
                ),
            ),
            lambda i: i.isNotNull(),
        ),
    )

    def chunk(end, j):
        start = F.when(j > 0, F.get("_ends", j - 1) + 1).otherwise(0)
        moved = F.when(j > 0, F.length(F.get("_prompts", start - 1))).otherwise(0)
        text = F.array_join(F.slice("segments", start + 1, end - start + 1), "")
        text = F.concat(F.substring(text, moved + 1, F.length(text)), F.get("_prompts", end))
        # The first chunk of a thinking row goes without the system block, which is its own chunk.
        text = F.when(
            F.col("thinking") & (j == 0),
            F.substring(text, F.length("_system") + F.lit(1), F.length(text)),
        ).otherwise(text)
        return F.struct(F.get(messages, end)["role"].alias("role"), text.alias("content"))

    system = F.array(F.struct(F.lit("system").alias("role"), F.col("_system").alias("content")))
    chunks = F.transform("_ends", chunk)
    done = done.withColumn(
        out, F.when(F.col("thinking"), F.concat(system, chunks)).otherwise(chunks)
    )
    return done.drop("segments", "_prompts", "_ends", "_leads", "_last_user", "_system")


def split_system_user(df, chunks="chunks"):
    """Cut a first user chunk that also holds the system block into two chunks."""
    first = F.get(chunks, F.lit(0))
    text = first["content"]
    both = (
        (first["role"] == "user")
        & F.contains(text, F.lit(START + "system"))
        & F.contains(text, F.lit(START + "user"))
    )
    head = F.struct(
        F.lit("system").alias("role"),
        F.substring(text, F.lit(1), F.instr(text, END) + F.lit(len(END) - 1)).alias("content"),
    )
    tail = F.struct(
        F.lit("user").alias("role"),
        F.substring(text, F.instr(text, START + "user"), F.length(text)).alias("content"),
    )
    rest = F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0)))
    return df.withColumn(
        chunks, F.when(F.coalesce(both, F.lit(False)), F.concat(F.array(head, tail), rest)).otherwise(F.col(chunks))
    )


def loss_mask(df, chunks="chunks", ids="input_ids", mask="loss_mask"):
    """Token ids chunk by chunk and a mask that is 1 on assistant tokens."""
    coded = F.transform(
        chunks, lambda c: F.struct(token_ids(c["content"]).alias("ids"), (c["role"] == "assistant").cast("int").alias("m"))
    )
    return (
        df.withColumn("_coded", coded)
        .withColumns(
            {
                ids: F.flatten("_coded.ids"),
                mask: F.flatten(F.transform("_coded", lambda c: F.array_repeat(c["m"], F.size(c["ids"])))),
            }
        )
        .drop("_coded")
    )


def chat_sequences(df, messages="messages", tools=None, max_tokens=None):
    """Conversations to (input_ids, loss_mask): expand, drop, chunk, mask, truncate."""
    expanded = droppable(expand_turns(full_messages(df, messages), messages), messages)
    kept = expanded.filter(~F.col("droppable")).drop("droppable")
    out = loss_mask(split_system_user(role_chunks(kept, messages, tools)))
    if max_tokens is not None:
        from quarry.operators.tokens import truncate_tokens

        # Truncation names the arrays several times; they are computed once before it.
        out = compute_once(out, _ids=F.col("input_ids"), _mask=F.col("loss_mask")).drop("input_ids", "loss_mask")
        out = out.withColumnsRenamed({"_ids": "input_ids", "_mask": "loss_mask"})
        out = truncate_tokens(out, max_tokens, mask="loss_mask")
    return out
