"""User functions: column transforms, scores, modifiers, blocks, table functions and aggregates."""

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf


def score(df, fn, out, column="text"):
    """Add a score. `fn` takes a column and returns one: an expression or an Arrow function."""
    return df.withColumn(out, fn(F.col(column)))


def keep(df, fn, column):
    return df.filter(fn(F.col(column)))


def score_filter(df, fn, out, condition, column="text"):
    return keep(score(df, fn, out, column), condition, out)


def modify(df, fn, column="text"):
    return df.withColumn(column, fn(F.col(column)))


def block_stage(df, fn, schema):
    """A pandas block function; None drops the block."""

    def run(blocks):
        for block in blocks:
            result = fn(block)
            if result is not None:
                yield result

    return df.mapInPandas(run, schema)


def register_table_functions(spark):
    """`split_lines(text)` for SQL users: (segment_id, segment)."""

    @udtf(returnType="segment_id int, segment string")
    class SplitLines:
        def eval(self, text: str):
            for number, line in enumerate((text or "").split("\n")):
                yield number, line

    spark.udtf.register("split_lines", SplitLines)


# --- user-defined aggregates -------------------------------------------------

# Keys whose states a task holds before it hands them on.
HELD_KEYS = 10_000


@dataclass(frozen=True)
class Aggregate:
    """An aggregate with a state that can be merged: a tuple in the order of the columns of `state` (DDL).

    `partial` makes the state of a pandas frame of `columns`, `merge` one state of two; `merge` has to
    be associative and commutative up to rounding, as the order of states is open.
    """

    columns: tuple
    state: str
    partial: Callable
    merge: Callable


def aggregate(df, agg, keys, slices=256):
    """One row per group of `keys` (null is a key) with the state columns of `agg`; no rows give no groups.

    Tasks combine their rows per key as they read them, so a key sends one state per task at most (or per
    `HELD_KEYS` keys). The states of a key are merged in `slices` first, then in one place: a hot key
    never brings its rows together, only states, and a task holds one state at a time.
    """
    named = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_key")
    rows = df.select(named, *agg.columns)
    shape = f"_key string, {agg.state}"
    fields = df.sparkSession.createDataFrame([], agg.state).columns

    def table(states):
        return pd.DataFrame([(k, *s) for k, s in states], columns=["_key", *fields])

    def combine(frames):
        held = {}
        for frame in frames:
            for key, part in frame.groupby("_key", sort=False):
                state = agg.partial(part)
                held[key] = agg.merge(held[key], state) if key in held else state
            if len(held) > HELD_KEYS:
                yield table(held.items())
                held = {}
        if held:
            yield table(held.items())

    def merge(frames):
        key, state = None, None
        for frame in frames:
            done = []
            for found, *part in frame.itertuples(index=False, name=None):
                if found == key:
                    state = agg.merge(state, tuple(part))
                    continue
                if key is not None:
                    done.append((key, state))
                key, state = found, tuple(part)
            if done:
                yield table(done)
        if key is not None:
            yield table([(key, state)])

    states = rows.mapInPandas(combine, shape).withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
    sliced = states.repartition("_key", "_slice").sortWithinPartitions("_key").drop("_slice").mapInPandas(merge, shape)
    whole = sliced.repartition("_key").sortWithinPartitions("_key").mapInPandas(merge, shape)
    group = F.from_json("_key", df.select(*keys).schema).alias("_group")
    return whole.select(group, *fields).select("_group.*", *fields)


def register_aggregate(spark, name, agg):
    """For SQL users: `<name>_partial(columns...)` and `<name>_merge(state)`, both aggregates; a state is a
    JSON list. A large group is cut by an inner GROUP BY over the key and a slice of its rows."""

    def partial(*columns: pd.Series) -> str:
        state = agg.partial(pd.concat(columns, axis=1, keys=agg.columns))
        return json.dumps([x.item() if hasattr(x, "item") else x for x in state])

    def merge(states: pd.Series) -> str:
        total = None
        for state in states.dropna():
            total = tuple(json.loads(state)) if total is None else agg.merge(total, tuple(json.loads(state)))
        return None if total is None else json.dumps([x.item() if hasattr(x, "item") else x for x in total])

    spark.udf.register(f"{name}_partial", F.pandas_udf(partial, "string"))
    spark.udf.register(f"{name}_merge", F.pandas_udf(merge, "string"))


def weighted_moments(value, weight):
    """Rows, weight, weighted mean and sum of squared deviations. Rows without a value or with no weight above 0 don't count."""

    def partial(frame):
        x, w = frame[value].to_numpy(np.float64), frame[weight].to_numpy(np.float64)
        counts = ~np.isnan(x) & (w > 0)
        x, w = x[counts], w[counts]
        if not len(x):
            return 0, 0.0, 0.0, 0.0
        mean = float(np.average(x, weights=w))
        return len(x), float(w.sum()), mean, float((w * (x - mean) ** 2).sum())

    def merge(a, b):
        if not a[0] or not b[0]:
            return a if a[0] else b
        weight, gap = a[1] + b[1], b[2] - a[2]
        return a[0] + b[0], weight, a[2] + gap * b[1] / weight, a[3] + b[3] + gap * gap * a[1] * b[1] / weight

    return Aggregate((value, weight), "n bigint, weight double, mean double, squares double", partial, merge)
