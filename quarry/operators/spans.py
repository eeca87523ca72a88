"""Repeated token spans: find, normalise, remove, rebuild the text."""

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F, types as T

from quarry.functions.columns import col, let, spelled
from quarry.plans.checkpoints import cut_lineage, drop_stored
from quarry.plans.skew import HOT_ROWS, join_groups

# Fixed value: a token with the white space before it, so that joining gives the text back.
PIECE = r"\s*(?:[A-Za-z0-9_À-ÿ]+|[^A-Za-z0-9_À-ÿ\s])|\s+$"


def pieces(text="text"):
    return F.regexp_extract_all(col(text), F.lit(spelled(PIECE)), F.lit(0))


def rolling(values, width, base):
    """Polynomials modulo 2^64 over every run of `width` (already random) token hashes, for all runs at once."""
    values = np.asarray(values, dtype=np.int64).view(np.uint64)
    n = len(values) - width + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    # Running sums of values over powers of the base, which is odd and so has an inverse modulo
    # 2^64: a run is the difference of two sums, times a power, whatever its width.
    falling, rising = (np.full(len(values), b, np.uint64) for b in (pow(base, -1, 1 << 64), base))
    falling[0] = rising[0] = 1
    sums = np.cumsum(values * np.cumprod(falling), dtype=np.uint64)
    total = sums[width - 1 :].copy()
    total[1:] -= sums[: n - 1]
    return total * np.cumprod(rising)[width - 1 :]


BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CHUNK = 1 << 18


def winnowed(hashes, k):
    """(grams, chosen): hashes of the runs of k // 2 tokens, and for every k-token window the place of its smallest one.

    Windows with equal text choose the same place inside of them, and neighbours mostly choose the same gram.
    """
    width = max(k // 2, 1)
    grams = rolling(hashes, width, BASES[0])
    count, span = len(hashes) - k + 1, k - width + 1
    if count < 1:
        return grams, np.zeros(0, np.int64)
    chosen = np.empty(count, np.int64)
    for at in range(0, count, CHUNK):
        part = grams[at : min(at + CHUNK, count) + span - 1]
        chosen[at : at + CHUNK] = np.lib.stride_tricks.sliding_window_view(part, span).argmin(axis=1)
    return grams, chosen + np.arange(count)


def sample_grams(k):
    """Arrow function: hash and place of every gram that a window of the document chooses."""
    shape = T.StructType([T.StructField("key", T.ArrayType(T.LongType())), T.StructField("pos", T.ArrayType(T.LongType()))])

    @F.pandas_udf(shape)
    def run(hashes: pd.Series) -> pd.DataFrame:
        def one(values):
            grams, chosen = winnowed(values, k)
            places = np.unique(chosen)
            return grams[places].view(np.int64), places

        found = [one(h) if h is not None else (None, None) for h in hashes]
        return pd.DataFrame({"key": [f[0] for f in found], "pos": [f[1] for f in found]})

    return run


def candidate_windows(k):
    """Arrow function: place and two 64-bit hashes of every window whose chosen gram is among the hits."""
    shape = T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in ("pos", "a", "b")])

    @F.pandas_udf(shape)
    def run(first: pd.Series, second: pd.Series, hits: pd.Series) -> pd.DataFrame:
        def one(values, others, places):
            _, chosen = winnowed(values, k)
            pos = np.flatnonzero(np.isin(chosen, np.asarray(places)))
            return pos, rolling(values, k, BASES[0])[pos].view(np.int64), rolling(others, k, BASES[1])[pos].view(np.int64)

        found = [one(*row) for row in zip(first, second, hits)]
        return pd.DataFrame({c: [f[j] for f in found] for j, c in enumerate(("pos", "a", "b"))})

    return run


def repeated_windows(tokens, k=50, keep="first", id="doc_id", column="tokens", hot_rows=HOT_ROWS):
    """(id, pos) of every k-token window to remove: its text occurs twice or more.

    `column` holds token arrays or texts. Two passes. The first shuffles winnowed samples only, about one gram of k / 2 tokens for
    every k / 4 tokens: a window that occurs twice chooses a gram that occurs twice. The second
    takes the documents with such grams and shuffles 16-byte hashes of the windows that chose
    them; the hashes of whole windows decide.
    """
    # A text is cut into tokens in both passes, so that no token array is shuffled.
    words = pieces(column) if dict(tokens.dtypes)[column] == "string" else F.col(column)
    first, second = (F.transform(words, f) for f in (lambda t: F.xxhash64(t), lambda t: F.xxhash64(F.lit(1), t)))
    sampled = tokens.select(id, sample_grams(k)(first).alias("s"))
    grams = cut_lineage(sampled.select(id, F.explode(F.arrays_zip("s.key", "s.pos")).alias("g")).select(id, "g.key", "g.pos"))
    often = cut_lineage(grams.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    hits = join_groups(grams, often, ["key"], [id, "pos"], hot_rows=hot_rows, null_keys=False)
    hits = cut_lineage(hits.groupBy(id).agg(F.collect_list("pos").alias("_hits")))
    drop_stored(grams)
    near = tokens.join(hits, id).select(id, candidate_windows(k)(first, second, F.col("_hits")).alias("h"))
    zipped = near.select(id, F.explode(F.arrays_zip("h.pos", "h.a", "h.b")).alias("w"))
    # Two longs as keys sort by their first bytes, which structs don't.
    hashes = ["_a", "_b"]
    spots = cut_lineage(zipped.select(id, "w.pos", F.col("w.a").alias("_a"), F.col("w.b").alias("_b")))
    place = places(hits, id)
    groups = cut_lineage(
        spots.groupBy(*hashes).agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    )
    found = join_groups(spots, groups, hashes, [id, "pos"], hot_rows=hot_rows, null_keys=False)
    if keep == "first":
        found = found.filter(place != F.col("first"))
    return found.select(id, "pos")


def places(hits, id):
    """One number for (id, pos), in their order, which keeps an aggregation a hash aggregation; structs would sort.

    A long, if the ids of `hits` lie within 2^32; else a decimal, which takes several times as long.
    """
    if dict(hits.dtypes)[id] not in ("bigint", "int"):
        return F.struct(id, "pos")
    low, high = hits.agg(F.min(id), F.max(id)).first()
    if low is None or high - low < 1 << 32:
        return F.shiftleft(F.col(id).cast("bigint") - F.lit(low or 0).cast("bigint"), 31) + F.col("pos")
    return F.col(id).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("pos")


def repeated_spans(tokens, k=50, keep="first", id="doc_id", column="tokens", hot_rows=HOT_ROWS):
    """(id, start, end) half-open token ranges: the union of repeated windows."""
    found = repeated_windows(tokens, k, keep, id, column, hot_rows)
    order = Window.partitionBy(id).orderBy("pos")
    gap = F.col("pos") - F.lag("pos").over(order)
    return (
        found.withColumn("_new", F.when(gap.isNull() | (gap > k), 1).otherwise(0))
        .withColumn("_island", F.sum("_new").over(order))
        .groupBy(id, "_island")
        .agg(F.min("pos").cast("bigint").alias("start"), (F.max("pos") + k).cast("bigint").alias("end"))
        .drop("_island")
    )


def overlap_join(spans, docs, block=1 << 20):
    """Spans (start, end) with the documents (doc_start, doc_end) they touch.

    Both sides are cut into fixed blocks of the offset range and joined on the
    block number; a pair is kept in the first block both share.
    """
    cover = lambda s, e: F.sequence(F.floor(s / block), F.floor((e - 1) / block))
    left = spans.filter("end > start").withColumn("_block", F.explode(cover(F.col("start"), F.col("end"))))
    right = docs.filter("doc_end > doc_start").withColumn(
        "_block", F.explode(cover(F.col("doc_start"), F.col("doc_end")))
    )
    first = F.floor(F.greatest("start", "doc_start") / block)
    joined = left.join(right, "_block").filter(
        (F.col("start") < F.col("doc_end")) & (F.col("end") > F.col("doc_start")) & (F.col("_block") == first)
    )
    return joined.drop("_block")


def normalize_spans(spans, docs, threshold, unit=1, separator=0, id="doc_id", block=1 << 20):
    """Clip removal ranges to documents, skip the separator, round inwards to
    whole units, keep them apart from the previous removal and drop short rests.

    A range that crosses the end of a document goes on in the next one.
    """
    spots = F.struct(
        F.greatest("start", "doc_start").alias("start"), F.least("end", "doc_end").alias("end")
    )
    per_doc = (
        overlap_join(spans, docs, block)
        .groupBy(id, "doc_start", "doc_end")
        .agg(F.array_sort(F.collect_list(spots)).alias("spots"))
        .withColumn("_base", F.col("doc_start") + separator)
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(state, spot):
        base = F.col("_base")
        start = F.greatest(spot["start"], state["free"])
        start = base + F.ceil((start - base) / unit) * unit
        end = base + F.floor((spot["end"] - base) / unit) * unit
        good = end - start >= threshold
        taken = F.concat(state["kept"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct(
            F.when(good, taken).otherwise(state["kept"]).alias("kept"),
            F.when(good, end).otherwise(state["free"]).alias("free"),
        )

    start_state = F.struct(empty.alias("kept"), F.col("_base").cast("bigint").alias("free"))
    folded = per_doc.select(id, F.aggregate("spots", start_state, step, lambda s: s["kept"]).alias("kept"))
    return folded.select(id, F.explode("kept").alias("s")).select(id, "s.start", "s.end")


def without(array, spans):
    """The array without the sorted (start, end) ranges: slices between them, no test per entry."""
    start = F.struct(F.slice(array, F.lit(1), F.lit(0)).alias("out"), F.lit(0).cast("bigint").alias("at"))

    def piece(begin, length):
        return F.slice(array, (begin + 1).cast("int"), F.greatest(length, F.lit(0)).cast("int"))

    def step(state, span):
        kept = F.concat(state["out"], piece(state["at"], span["start"] - state["at"]))
        return F.struct(kept.alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], piece(s["at"], F.size(array) - s["at"])))


def with_spans(df, spans, id):
    """Rows with their sorted spans in `_spans` (null if none): the one join of full rows."""
    entry = F.struct(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))
    per_doc = spans.groupBy(id).agg(F.array_sort(F.collect_list(entry)).alias("_spans"))
    return df.join(per_doc, id, "left")


def remove_spans(tokens, spans, id="doc_id", column="tokens"):
    """Token arrays without the spans. Documents that lose all tokens stay, empty.

    `column` holds token arrays or texts; texts are joined as they are and cut into tokens after it.
    """
    joined = with_spans(tokens, spans, id)
    words = pieces(column) if dict(tokens.dtypes)[column] == "string" else F.col(column)
    cut = let(words, lambda t: F.when(F.col("_spans").isNull(), t).otherwise(without(t, F.col("_spans"))))
    return joined.withColumn(column, cut).drop("_spans")


def substring_dedup(df, k=50, keep="first", id="doc_id", text="text"):
    """Remove repeated spans of at least k tokens; no other column changes.

    Tokens never leave the row: the small span table meets the rows once, and only texts with
    a span are cut into tokens again. A null text becomes empty.
    """
    joined = with_spans(df, repeated_spans(df.select(id, text), k, keep, id, text), id)
    cut = let(pieces(text), lambda t: F.array_join(without(t, F.col("_spans")), ""))
    whole = F.coalesce(F.col(text), F.lit(""))
    return joined.withColumn(text, F.when(F.col("_spans").isNull(), whole).otherwise(cut)).select(*df.columns)
