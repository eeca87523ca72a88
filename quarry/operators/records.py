"""Record shaping: projections that drop a record when a required field is missing.

By default a null field counts as missing. Where a JSON null must be kept apart
from an absent key, read the lines as text and call `require_keys` first.
"""

from pyspark.sql import functions as F

from quarry.functions.columns import nested


def require_keys(df, raw, *fields):
    """Keep raw JSON lines that have every field as a key, null values included."""
    keys = F.json_object_keys(F.col(raw))
    keep = F.lit(True)
    for field in fields:
        keep = keep & F.array_contains(keys, field)
    return df.filter(keep)


def sft(df, input="input", output="output", system=None):
    kept = df.dropna(subset=[input, output])
    columns = [F.col(input).alias("input"), F.col(output).alias("output")]
    if system and system in df.columns:
        columns.append(F.col(system).alias("system"))
    return kept.select(*columns)


def openai_chat(df, messages="messages"):
    return df.dropna(subset=[messages]).select(F.col(messages).alias("messages"))


def sharegpt(df, conversations="conversations"):
    return df.dropna(subset=[conversations]).select(F.col(conversations).alias("conversations"))


def rl_messages(df, params="responses_create_params", keep=()):
    """`params.input` as messages; `tools` only where it is not empty."""
    tools = nested(params, ["tools"])
    return df.select(
        *keep,
        nested(params, ["input"]).alias("messages"),
        F.when(F.size(tools) > 0, tools).alias("tools"),
    ).dropna(subset=["messages"])


def passthrough(df):
    return df


def select_fields(df, *fields):
    return df.select(*fields).dropna("any")


def rename_fields(df, **mapping):
    """Keep only the mapped fields, new name = old name."""
    return df.dropna(subset=list(mapping.values())).select(
        *[F.col(old).alias(new) for new, old in mapping.items()]
    )


def apply_transform(df, fn, schema=None):
    """A record transform: DataFrame -> DataFrame, or row dict -> dict / None with a schema."""
    if schema is None:
        return df.transform(fn)

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    shape = to_arrow_schema(schema if isinstance(schema, StructType) else StructType.fromDDL(schema))

    def blocks(batches):
        # Rows come from Arrow, not from a pandas frame, which turns null integers into NaN.
        for batch in batches:
            rows = [fn(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([row for row in rows if row is not None], schema=shape)

    return df.mapInArrow(blocks, schema)


def messages_from_turns(df, by="conv_id", turn="turn", role="role", text="text"):
    """One row per conversation from one row per turn, in turn order."""
    entry = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    grouped = df.groupBy(by).agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    return grouped.select(
        by,
        F.transform(
            "turns", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
        ).alias("messages"),
    )


def drop_columns(df, *names):
    return df.drop(*names)


def concat_text(df, first, second, out="text"):
    return df.withColumn(out, F.concat(F.col(first), F.col(second)))


def add_doc_id(df, by, out="id"):
    """Unique id when absent: 0-based position by a stable numeric key."""
    from quarry.plans.prefix import position

    return df if out in df.columns else position(df, by, out=out)


def limit_rows(df, n, by=None, order=None):
    """First n rows; with `by`, the first n in order per source.

    The row-number filter is pushed below the shuffle, so every map task sends
    at most n rows per source.
    """
    if by is None:
        return (df.orderBy(order) if order else df).limit(n)
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn("_row", F.row_number().over(w)).filter(F.col("_row") <= n).drop("_row")
