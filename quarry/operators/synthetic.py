"""Preparation and post-processing around text generation on good documents."""

import numpy as np
from pyspark.sql import functions as F, types as T

from quarry.functions.columns import TOKEN, token_count
from quarry.functions.text import remove_lines, remove_markdown, slice_after, unquote
from quarry.operators.filters import substring_filter, token_count_filter
from quarry.operators.tokens import worker_resource
from quarry.plans.checkpoints import cut_lineage
from quarry.plans.once import compute_once
from quarry.plans.slices import SLICE, in_slices

# Limits per task (tokens) and the lines and prefix removed afterwards.
LIMITS = {
    "diverse_qa": dict(min_document=30, min_segment=30, max_input=1000, max_output=600),
    "distill": dict(min_document=30, min_segment=10, max_input=2000, max_output=1600),
    "extract_knowledge": dict(min_document=30, min_segment=30, max_input=1400, max_output=1400),
    "knowledge_list": dict(min_document=30, min_segment=30, max_input=1000, max_output=600),
}
PASSAGE_LINES = ["Passage:", "Passage 1:", "Passage 2:", "Passage 3:"]
PARAPHRASE = "Paraphrased Text:"

# The number of tokens of a reply, which `generate` can add.
REPLY_COUNT = "rephrased_segment_token_count"

# Prompts of this package; `{text}` is replaced by the segment.
SYSTEM = "You are a careful assistant. Answer only from the given text."
TEMPLATES = {
    "diverse_qa": "Write varied questions with answers about this text. Use lines 'Question:' and 'Answer:'.\n\n{text}",
    "distill": "Rewrite this text briefly and keep every fact. Begin with 'Paraphrased Text:'.\n\n{text}",
    "extract_knowledge": "Write down the knowledge in this text as plain passages.\n\n{text}",
    "knowledge_list": "List the facts of this text as bullet points.\n\n{text}",
}


def prefix_tokens(task):
    """Tokens of the prompt without the text, counted like `token_count`."""
    import re

    return len(re.findall(TOKEN, SYSTEM + "\n" + TEMPLATES[task].replace("{text}", "")))


def max_segment_tokens(task):
    return LIMITS[task]["max_input"] - prefix_tokens(task) - 2


def split_documents(df, text="text", id="doc_id", sep="\n"):
    """(id, segment_id, text): one row per line."""
    return df.select(id, F.posexplode_outer(F.split(text, sep)).alias("segment_id", text))


def counted_lines(df, text="text", id="doc_id", sep="\n"):
    """(id, lines): the lines of a document with their numbers of tokens, which later filters don't count again."""
    lines = F.transform(F.split("_text", sep), lambda s: F.struct(s.alias("text"), token_count(s).alias("n")))
    return compute_once(df.select(id, F.col(text).alias("_text")), lines=lines).select(id, "lines")


def join_segments(df, max_tokens, text="text", id="doc_id", sep="\n"):
    """(id, segment_id, text, segment_token_count): neighbouring lines of a document
    joined while the sum stays within `max_tokens`; longer lines are left out.

    A fold over the lines of one row, so documents are neither exploded nor shuffled.
    """
    return join_lines(counted_lines(df, text, id, sep), max_tokens, text, id, sep)


def join_lines(counted, max_tokens, text="text", id="doc_id", sep="\n"):
    """As `join_segments`, from the rows of `counted_lines`."""
    piece = "struct<text:string,n:bigint>"
    lines = F.filter("lines", lambda s: s["n"] <= max_tokens)
    start = F.struct(
        F.array().cast(f"array<{piece}>").alias("done"), F.lit(None).cast(piece).alias("open")
    )

    def step(state, line):
        joined = F.struct(
            F.concat(state["open"]["text"], F.lit(sep), line["text"]).alias("text"),
            (state["open"]["n"] + line["n"]).alias("n"),
        )
        fits = state["open"]["n"] + line["n"] <= max_tokens
        return (
            F.when(state["open"].isNull(), F.struct(state["done"].alias("done"), line.alias("open")))
            .when(fits, F.struct(state["done"].alias("done"), joined.alias("open")))
            .otherwise(F.struct(F.concat(state["done"], F.array(state["open"])).alias("done"), line.alias("open")))
        )

    def finish(state):
        return F.when(state["open"].isNull(), state["done"]).otherwise(
            F.concat(state["done"], F.array(state["open"]))
        )

    folded = counted.select(id, F.posexplode_outer(F.aggregate(lines, start, step, finish)).alias("segment_id", "s"))
    return folded.filter("s is not null").select(
        id, "segment_id", F.col("s.text").alias(text), F.col("s.n").alias("segment_token_count")
    )


def prepare_segments(df, task, text="text", id="doc_id"):
    """Segments of one task, from documents."""
    return task_segments(counted_lines(df, text, id), task, text, id)


def task_segments(counted, task, text="text", id="doc_id"):
    """Segments of one task, from the rows of `counted_lines`. No token crosses a line break, so a
    document has the tokens of its lines."""
    limits = LIMITS[task]
    total = F.aggregate("lines", F.lit(0).cast("bigint"), lambda n, line: n + line["n"])
    parts = join_lines(counted.filter(total >= limits["min_document"]), max_segment_tokens(task), text, id)
    return parts.filter(F.col("segment_token_count") >= limits["min_segment"])


def build_prompts(df, task, text="text", out="prompt"):
    filled = F.replace(F.lit(TEMPLATES[task]), F.lit("{text}"), F.col(text))
    return df.withColumn(out, F.concat(F.lit(SYSTEM + "\n"), filled))


# What a byte of UTF-8 is for TOKEN: a letter, a token by itself (first bytes of other characters
# too), or nothing (white space, later bytes). U+00C0 to U+00FF are all that begins with 0xC3.
_LETTER, _ALONE = 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[33:127], _KINDS[127], _KINDS[192:] = _ALONE, _ALONE, _ALONE
_KINDS[:9], _KINDS[14:32] = _ALONE, _ALONE
_KINDS[[c for c in range(128) if chr(c).isalnum() or chr(c) == "_"] + [0xC3]] = _LETTER


def count_tokens(text):
    """As `token_count`, for a Python string: without a match for every token."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = _KINDS[data]
    letters = kinds == _LETTER
    # The later byte of a letter.
    letters[1:] |= data[:-1] == 0xC3
    return int((kinds == _ALONE).sum() + letters[:1].sum() + (letters[1:] & ~letters[:-1]).sum())


def generate(df, client_factory, prompt="prompt", out="generated", concurrency=4, retries=3, delay=1.0, count=None):
    """Call a text generator for every row with bounded concurrency and retries.

    `client_factory()` returns a callable prompt -> text and runs once per worker.
    A row that still fails after the retries raises. Replies are not repeatable, so no later
    filter asks for them again. `count` names a column for their numbers of tokens.
    """
    shape = T.StructType([T.StructField("reply", T.StringType()), T.StructField("n", T.LongType())])

    def run(prompts):
        import time
        from concurrent.futures import ThreadPoolExecutor

        client = worker_resource(f"client_{out}", client_factory)

        def one(text):
            for attempt in range(retries + 1):
                try:
                    return client(text)
                except Exception:
                    if attempt == retries:
                        raise
                    time.sleep(delay * 2**attempt)

        with ThreadPoolExecutor(concurrency) as pool:
            replies = list(pool.map(one, prompts))
        return [{"reply": r, "n": count_tokens(r) if count and r is not None else None} for r in replies]

    # A worker holds the prompts and replies of a few rows per thread.
    ask = in_slices(run, shape, max(SLICE, 16 * concurrency))
    asked = df.withColumn("_reply", ask.asNondeterministic()(F.col(prompt)))
    added = {out: F.col("_reply.reply")} | ({count: F.col("_reply.n")} if count else {})
    return asked.withColumns(added).drop("_reply")


def limit_output(df, task, column):
    """Drop outputs that reached the output limit (2 tokens are kept free)."""
    most = LIMITS[task]["max_output"] - 2
    if REPLY_COUNT in df.columns:
        return df.filter(F.col(REPLY_COUNT) <= most)
    return token_count_filter(df, column, max=most, out=REPLY_COUNT)


def clean_qa(column, text, tokens_per_pair=50):
    """Question / answer pairs of a reply, at most one per `tokens_per_pair` input
    tokens (at least one), appended to the source text. Replies without a pair give null."""
    pairs = F.regexp_extract_all(
        column, F.lit(r"(Question:[^\n]*\n+Answer:[^\n]*)"), F.lit(1)
    )
    allowed = F.greatest(F.lit(1), F.floor(token_count(text) / tokens_per_pair).cast("int"))
    body = F.array_join(F.slice(pairs, F.lit(1), allowed), "\n\n")
    return F.when(F.size(pairs) > 0, F.concat(F.col(text), F.lit("\n\n"), body))


def clean_list(column):
    """Drop a first line that is no bullet; strip bullets and indent."""
    lines = F.split(column, "\n")
    bullet = r"^\s*(?:[-*•]|[0-9]+[.)])\s*"
    kept = F.filter(lines, lambda x, i: (i > 0) | x.rlike(bullet))
    return F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, r"^\s*(?:[-*•]|[0-9]+[.)])?\s*", "")), "\n")


def _final(df, column, least):
    return token_count_filter(df, column, min=least, out="rephrased_document_token_count")


def post_diverse_qa(df, column="diverse_qa", text="text"):
    kept = limit_output(df, "diverse_qa", column).withColumn(column, remove_markdown(column))
    return _final(kept.withColumn(column, clean_qa(column, text)), column, 100)


def post_distill(df, column="distill"):
    kept = limit_output(df, "distill", column).withColumn(column, remove_markdown(column))
    kept = substring_filter(kept, column, PARAPHRASE, "prefix")
    return _final(kept.withColumn(column, unquote(slice_after(column, PARAPHRASE))), column, 50)


def post_extract(df, column="extract_knowledge"):
    kept = limit_output(df, "extract_knowledge", column)
    return _final(kept.withColumn(column, remove_lines(remove_markdown(column), PASSAGE_LINES)), column, 50)


def post_list(df, column="knowledge_list"):
    kept = limit_output(df, "knowledge_list", column).withColumn(column, remove_markdown(column))
    return _final(kept.withColumn(column, clean_list(column)), column, 50)


POST = {
    "diverse_qa": post_diverse_qa,
    "distill": post_distill,
    "extract_knowledge": post_extract,
    "knowledge_list": post_list,
}


def run_segments(segments, task, client_factory, **settings):
    prompts = build_prompts(segments, task)
    return POST[task](generate(prompts, client_factory, out=task, count=REPLY_COUNT, **settings)).drop("prompt")


def run_task(df, task, client_factory, **settings):
    return run_segments(prepare_segments(df, task), task, client_factory, **settings)


def run_tasks(df, client_factory, tasks=tuple(LIMITS), **settings):
    """task name -> DataFrame. The lines are counted once for all tasks, and stored."""
    counted = cut_lineage(counted_lines(df))
    return {task: run_segments(task_segments(counted, task), task, client_factory, **settings) for task in tasks}
