"""Tokenization, special tokens, truncation, statistics and the index layout."""

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from quarry.functions.columns import EOS_ID, token_ids
from quarry.operators.bpe import Tokenizer
from quarry.plans.prefix import quantile_bucket, running_totals
from quarry.plans.slices import in_slices


def worker_resource(name, factory):
    """Build a resource once per Python worker and keep it for later batches."""
    store = sys.modules.setdefault("_worker_resources", types.ModuleType("_worker_resources"))
    if not hasattr(store, name):
        setattr(store, name, factory())
    return getattr(store, name)


# Rows of a batch whose bytes become numbers at a time.
BYTE_ROWS = 256


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def byte_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch), BYTE_ROWS):
            texts = batch.slice(at, BYTE_ROWS).cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            yield pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), pa.array(data.astype(np.int32)), mask=texts.is_null())


def plugin_tokenizer(name, factory):
    """Arrow function around a user tokenizer (`factory()` -> callable text -> ids).

    A text the tokenizer fails on gives null ids and the error; its neighbours in
    the batch are kept.
    """
    shape = T.StructType(
        [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("error", T.StringType())]
    )

    def run(texts):
        encode = worker_resource(name, factory)
        rows = []
        for text in texts:
            try:
                rows.append({"ids": list(encode(text)), "error": None})
            except Exception as error:
                rows.append({"ids": None, "error": f"{type(error).__name__}: {error}"})
        return rows

    return in_slices(run, shape)


def tokenize(df, text="text", tokenizer="regex", out="input_ids", on_error="fail"):
    """Add token ids. `tokenizer` is "regex", "bytes", one of the byte-pair tokenizers of
    `operators.bpe`, or the result of `plugin_tokenizer`.

    With on_error="skip" a row that fails keeps null ids and its `error` text;
    `token_stats` counts it and `drop_empty` removes it.
    """
    if tokenizer == "regex":
        return df.withColumn(out, token_ids(text))
    if tokenizer == "bytes":
        return df.withColumn(out, byte_ids(text))
    if isinstance(tokenizer, Tokenizer):
        return df.withColumn(out, tokenizer.ids_of(F.col(text)))
    done = df.withColumn("_t", tokenizer(F.col(text)))
    if on_error == "fail":
        checked = F.when(F.col("_t.error").isNotNull(), F.raise_error(F.col("_t.error")))
        return done.withColumn(out, F.coalesce(checked.cast("array<int>"), F.col("_t.ids"))).drop("_t")
    return done.withColumns({out: F.col("_t.ids"), "error": F.col("_t.error")}).drop("_t")


def add_special(df, bos=None, eos=EOS_ID, column="input_ids"):
    """Prepend BOS and append EOS where given; by default only EOS."""
    parts = [F.array(F.lit(bos))] if bos is not None else []
    parts.append(F.col(column))
    if eos is not None:
        parts.append(F.array(F.lit(eos)))
    return df.withColumn(column, F.concat(*parts))


def drop_empty(df, column="input_ids"):
    return df.filter(F.size(column) > 0)


def truncate_tokens(df, n, column="input_ids", mask=None, keep_eos=False, flag="truncated"):
    """Cut to n tokens after EOS was added, so a cut document loses its EOS unless
    `keep_eos`. Empty lists are dropped; `flag` marks the cut rows."""
    kept = drop_empty(df, column)
    cut = F.size(column) > n
    ids = F.slice(column, 1, n)
    if keep_eos:
        ids = F.when(cut, F.concat(F.slice(column, 1, n - 1), F.slice(column, -1, 1))).otherwise(ids)
    columns = {flag: cut, column: ids}
    if mask:
        columns[mask] = F.slice(mask, 1, n)
    return kept.withColumns(columns)


def token_stats(df, by=(), column="input_ids", min_chars=None, text="text", max_tokens=None):
    """Counts per group in one aggregation: input, filtered, errors, truncated,
    sequences, total / min / max tokens."""
    n = F.size(column)
    short = F.lit(False) if min_chars is None else (F.char_length(text) < min_chars)
    good = ~short & F.col(column).isNotNull() & (n > 0)
    cut = F.lit(False) if max_tokens is None else n > max_tokens
    length = F.when(good, n if max_tokens is None else F.least(n, F.lit(max_tokens))).cast("bigint")
    return df.groupBy(*by).agg(
        F.count("*").alias("num_input_rows"),
        F.count_if(short).alias("num_filtered"),
        F.count_if(~short & F.col(column).isNull()).alias("num_errors"),
        F.count_if(good & cut).alias("num_truncated"),
        F.count_if(good).alias("num_sequences"),
        F.coalesce(F.sum(length), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.min(length), F.lit(0)).alias("min_length"),
        F.coalesce(F.max(length), F.lit(0)).alias("max_length"),
    )


def index_layout(df, order, length="length", by=(), itemsize=4):
    """Byte pointer (bytes of all earlier sequences) and 0-based document index."""
    cut = quantile_bucket(df, order).filter(F.col(length) > 0)
    values = {"_end": F.col(length).cast("bigint") * itemsize, "_count": F.lit(1).cast("bigint")}
    placed = running_totals(cut, values, [order], by=by)
    return placed.withColumns(
        {
            "pointer": F.col("_end") - F.col(length).cast("bigint") * itemsize,
            "document_index": F.col("_count") - 1,
        }
    ).drop("_bucket", "_end", "_count")
