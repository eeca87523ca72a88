"""Records for reinforcement learning: lookups, templates, answers, rollouts."""

from pyspark.sql import functions as F

from quarry.functions.columns import col, hash_fraction, nested
from quarry.operators.records import rl_messages
from quarry.operators.sharding import holdout_split
from quarry.plans.skew import HOT_ROWS, join_groups


def get_path(column, path):
    """Null-safe read of keys and list positions in a struct / array column."""
    return nested(column, path)


def get_json_path(column, path):
    """The same in a JSON text column."""
    steps = "".join(f"[{s}]" if isinstance(s, int) else f".{s}" for s in path)
    return F.get_json_object(column, "$" + steps)


def restore_wrapped(question, prefix, suffix):
    """Drop the first and last blank-line block of a question with three or more,
    put prefix and suffix around the rest and strip trailing line breaks."""
    question = col(question)
    parts = F.split(question, "\n\n")
    middle = F.when(
        F.size(parts) >= 3, F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), "\n\n")
    ).otherwise(question)
    text = F.concat(F.coalesce(prefix, F.lit("")), middle, F.coalesce(suffix, F.lit("")))
    return F.regexp_replace(text, r"\n+$", "")


def restore_template(question, template):
    """Fill `{question}`; a template without the marker gives the question itself."""
    question, template = col(question), col(template)
    marker = F.lit("{question}")
    filled = F.replace(template, marker, question)
    return F.when(F.contains(template, marker), filled).otherwise(question)


def parse_answer(column):
    """JSON answers: first list element, first object value, or the scalar; text
    that is not JSON stays as it is, and so do an empty list or object."""
    c = F.col(column) if isinstance(column, str) else column
    parsed = F.try_parse_json(c)
    kind = F.schema_of_variant(parsed)
    first_key = F.get(F.json_object_keys(c), F.lit(0))
    first_item = F.try_variant_get(parsed, "$[0]", "string")
    value = F.element_at(F.from_json(c, "map<string,string>"), first_key)
    return (
        F.when(parsed.isNull(), c)
        .when(kind.startswith("ARRAY"), F.coalesce(first_item, c))
        .when(kind.startswith("OBJECT"), F.when(first_key.isNull(), c).otherwise(value))
        .otherwise(F.try_variant_get(parsed, "$", "string"))
    )


def resolve_placeholders(records, sources, styles, keep=()):
    """Fill records that only point at row N of a named source.

    `records`: dataset, placeholder (struct row, prefix, suffix, template).
    `sources`: dataset, row, question, answer; (dataset, row) is unique. Many
    records may name one row: the join is cut into slices by the `keep` columns.
    `styles`: dataset name -> "wrapped" or "template". Records without a match,
    with an unknown data set or a null question are dropped.
    """
    known = F.col("dataset").isin(*styles)
    asked = records.filter(F.col("placeholder").isNotNull() & known).withColumn("row", F.col("placeholder.row"))
    named = asked.groupBy("dataset", "row").agg(F.count("*").alias("n"))
    rows = named.join(sources.filter("question is not null"), ["dataset", "row"])
    found = join_groups(asked, rows, ["dataset", "row"], keep or ["dataset"])
    style = F.lit(None).cast("string")
    for name, kind in styles.items():
        style = F.when(F.col("dataset") == name, kind).otherwise(style)
    p = F.col("placeholder")
    raw = F.col("question").cast("string")
    has_wrap = p["prefix"].isNotNull() | p["suffix"].isNotNull()
    wrapped = F.when(has_wrap, restore_wrapped(raw, p["prefix"], p["suffix"])).otherwise(raw)
    filled = F.coalesce(restore_template(raw, p["template"]), raw)
    full = F.when(style == "wrapped", wrapped).when(style == "template", filled).otherwise(raw)
    user = F.struct(F.lit("user").alias("role"), full.alias("content"))
    return found.select(
        *keep,
        "dataset",
        F.when(style == "template", raw).otherwise(full).alias("question"),
        parse_answer("answer").alias("expected_answer"),
        F.struct(F.array(user).alias("input")).alias("responses_create_params"),
    )


def unplaced(records, sources):
    """Placeholder records whose row does not exist."""
    asked = records.filter("placeholder is not null").withColumn("row", F.col("placeholder.row"))
    return asked.join(sources.filter("question is not null"), ["dataset", "row"], "left_anti")


def resolve_all(records, sources, styles, keep=()):
    """Resolved placeholders plus the plain records, as messages."""
    resolved = rl_messages(resolve_placeholders(records, sources, styles, keep).select(
        *keep,
        "question",
        "expected_answer",
        F.struct(
            F.col("responses_create_params.input").alias("input"),
            F.lit(None).cast("array<struct<name:string>>").alias("tools"),
        ).alias("responses_create_params"),
    ), keep=[*keep, "question", "expected_answer"])
    plain = rl_messages(records.filter("placeholder is null"), keep=keep)
    return resolved.unionByName(plain, allowMissingColumns=True)


def prep_rl(records, sources, styles, holdout, order, resolve=True):
    """Resolve (or just take the messages) and hold the last rows out."""
    out = resolve_all(records, sources, styles, keep=[order]) if resolve else rl_messages(records, keep=[order])
    return holdout_split(out, holdout, order)


def curriculum(rollouts, prompt="prompt", correct="correct"):
    """Pass rate per prompt; prompts that are always solved are dropped, the rest
    come sorted from easy to hard."""
    rated = rollouts.groupBy(prompt).agg(F.avg(F.col(correct).cast("double")).alias("pass_rate"), F.count("*").alias("n"))
    return rated.filter("pass_rate < 1").orderBy(F.desc("pass_rate"), prompt)


def group_advantage(rollouts, prompt="prompt", key="rollout", reward="reward", loo=True, normalize=True, hot_rows=HOT_ROWS):
    """Reward minus the baseline of the prompt's rollouts: their mean, or the mean of
    the others (leave one out); optionally divided by the sample deviation.

    Group sums are combined map-side and joined back in slices for huge groups.
    """
    stats = rollouts.groupBy(prompt).agg(
        F.count("*").alias("n"), F.sum(reward).alias("_sum"), F.stddev_samp(reward).alias("_std")
    )
    joined = join_groups(rollouts, stats, [prompt], [key], hot_rows=hot_rows)
    r = F.col(reward)
    if loo:
        base = F.when(F.col("n") > 1, (F.col("_sum") - r) / (F.col("n") - 1)).otherwise(0.0)
    else:
        base = F.col("_sum") / F.col("n")
    advantage = r - base
    if normalize:
        advantage = F.when(F.col("_std") > 0, advantage / F.col("_std")).otherwise(advantage)
    return joined.withColumn("advantage", advantage).drop("n", "_sum", "_std")


def circular_pairs(df, prompt="prompt", index="i", keep=("rollout",)):
    """Response i compared with i + 1, the last with the first.

    An equi-join on (prompt, index), which is unique on both sides; only the last
    response of each prompt needs the second join with the first responses.
    """
    right = df.select(prompt, (F.col(index) - 1).alias(index), *[F.col(c).alias(f"next_{c}") for c in keep])
    step = df.join(right, [prompt, index], "left")
    heads = df.filter(F.col(index) == 0).select(prompt, *[F.col(c).alias(f"first_{c}") for c in keep])
    inner = step.filter(F.col(f"next_{keep[0]}").isNotNull())
    last = step.filter(F.col(f"next_{keep[0]}").isNull()).drop(*[f"next_{c}" for c in keep])
    closed = last.join(heads, prompt)
    closed = closed.select(*last.columns, *[F.col(f"first_{c}").alias(f"next_{c}") for c in keep])
    return inner.select(closed.columns).unionByName(closed)


def overlong_filter(df, max_tokens, ids="input_ids", eos=2):
    """Drop rollouts that reached the limit without an end token."""
    ended = F.coalesce(F.try_element_at(ids, F.lit(-1)) == eos, F.lit(False))
    return df.filter((F.size(ids) < max_tokens) | ended)


def reasoning_control(df, strip, truncate, budget, key, seed=42, messages="messages"):
    """Empty the reasoning in a share of the records and cut it to `budget`
    words in another share, chosen by key hash."""
    share = hash_fraction(key, seed)
    names = [f for f in df.schema[messages].dataType.elementType.fieldNames() if f != "reasoning_content"]

    def change(m):
        words = F.split(m["reasoning_content"], " ")
        cut = F.array_join(F.slice(words, 1, budget), " ")
        value = (
            F.when(F.col("_share") < strip, F.lit(None).cast("string"))
            .when(F.col("_share") < strip + truncate, cut)
            .otherwise(m["reasoning_content"])
        )
        return F.struct(*[m[f].alias(f) for f in names], value.alias("reasoning_content"))

    return df.withColumn("_share", share).withColumn(messages, F.transform(messages, change)).drop("_share")
