"""Training pairs for text-to-SQL."""

from pyspark.sql import functions as F

from quarry.functions.columns import strip, token_count
from quarry.operators.filters import max_length

END_MARK = "<|im_end|>"


def sql_sft(df, reasoning=False, end_mark=END_MARK):
    """`input` from schema, question and evidence; `output` is the SQL with the end
    mark, after the reasoning where there is some."""
    prompt = strip(F.concat(F.lit("\n"), "schema", F.lit("\n\n"), "question", F.lit("\n"), "evidence", F.lit("\n")))
    answer = strip(F.col("SQL"))
    if reasoning:
        thought = strip(F.coalesce(F.col("reasoning_trace"), F.lit("")))
        with_thought = strip(F.concat(thought, F.lit("\n</think>\n\n"), F.col("SQL")))
        answer = F.when(F.length(thought) > 0, with_thought).otherwise(answer)
    return df.withColumns({"input": prompt, "output": F.concat(answer, F.lit(end_mark))})


def prep_text2sql(plain, reasoned=None, max_tokens=4096, keep=()):
    """Template, length, length filter, union, sort by length."""

    def one(df, reasoning):
        pairs = sql_sft(df, reasoning)
        text = F.concat("input", "output")
        sized = pairs.select(*keep, "input", "output", text.alias("text"), token_count(text).alias("length"))
        return max_length(sized, max_tokens)

    out = one(plain, False)
    if reasoned is not None:
        out = out.unionByName(one(reasoned, True))
    return out.orderBy("length")
