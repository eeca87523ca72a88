"""Quality scores, weighted percentile thresholds, integer bins and buckets."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.functions.columns import WORD, hash_fraction, let, words
from quarry.plans.checkpoints import cut_lineage
from quarry.plans.prefix import first_reaching

PERCENTS = tuple(range(5, 100, 5))


def alpha_share(text="text"):
    """Letters per character."""
    n = F.char_length(text)
    return F.when(n > 0, F.regexp_count(text, F.lit("[A-Za-zÀ-ÿ]")) / n).otherwise(0.0)


def distinct_word_share(text="text"):
    return let(
        words(F.lower(F.col(text))),
        lambda w: F.when(F.size(w) > 0, F.size(F.array_distinct(w)) / F.size(w)).otherwise(0.0),
    )


def score_documents(df, scorers):
    """Add one double column per scorer: a Column or a fitted model with `transform`."""
    for name, scorer in scorers.items():
        if hasattr(scorer, "transform") and not hasattr(scorer, "alias"):
            scored = scorer.transform(df)
            df = scored.select(*df.columns, vector_to_array("probability")[1].alias(name))
        else:
            df = df.withColumn(name, scorer.cast("double"))
    return df


def train_quality_model(df, text="text", label="quality", features=1 << 14):
    """Logistic regression over hashed words."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=WORD, gaps=False),
        HashingTF(inputCol="_words", outputCol="_features", numFeatures=features),
        LogisticRegression(featuresCol="_features", labelCol=label, maxIter=10, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(df.select(text, label))


def token_length(text="text"):
    return F.octet_length(text).cast("bigint")


def sample_frac(df, fraction, key, seed=42):
    """Repeatable sample by key hash; the share holds for every source file."""
    return df if fraction >= 1 else df.filter(hash_fraction(key, seed) < fraction)


def unpivot_scores(df, scores, weight):
    pairs = [F.struct(F.lit(c).alias("score_column"), F.col(c).alias("score")) for c in scores]
    return df.select(F.explode(F.array(*pairs)).alias("s"), F.col(weight).alias("weight")).select(
        "s.score_column", "s.score", "weight"
    )


def weighted_percentiles(df, percents=PERCENTS, by="score_column", score="score", weight="weight"):
    """Inverted-CDF weighted percentile of `score` per `by` group.

    Equal scores are summed first; only the buckets in which the percentiles lie are
    ranked (see `plans.prefix.first_reaching`).
    """
    sums = df.groupBy(by, score).agg(F.sum(weight).alias("_weight"))
    wanted = {p: (lambda run, total, p=p: run / total >= p / 100.0) for p in percents}
    found = first_reaching(sums, by, score, "_weight", wanted)
    # A group without any score keeps its rows, with null values.
    rows = df.select(by).distinct().select(by, F.explode(F.array(*[F.lit(p) for p in percents])).alias("percentile"))
    found = found.select(F.col(by).alias("_by"), F.col("name").cast("int").alias("_p"), "value")
    match = F.col(by).eqNullSafe(F.col("_by")) & (F.col("percentile") == F.col("_p"))
    return rows.join(found, match, "left").select(by, "percentile", "value")


def thresholds(df, scores, weight, percents=PERCENTS):
    """(score_column, percentile, value): one small table for all score columns."""
    return weighted_percentiles(unpivot_scores(df, scores, weight), percents)


def digitize(df, scores, table):
    """`<score>-int` = number of thresholds <= score. Thresholds may repeat.

    The whole threshold table (19 numbers per score) is read once, as a scalar.
    """
    per_score = table.groupBy("score_column").agg(F.array_sort(F.collect_list("value")).alias("v"))
    limits = per_score.agg(F.map_from_entries(F.collect_list(F.struct("score_column", "v"))).alias("m"))
    ready = df.withColumn("_limits", limits.scalar())

    def bin_of(score):
        return F.size(F.filter(F.col("_limits")[score], lambda t: t <= F.col(score)))

    return ready.withColumns({f"{score}-int": bin_of(score) for score in scores}).drop("_limits")


def ensemble_max(df, columns, out="ensemble-max-int"):
    return df.withColumn(out, F.greatest(*[F.col(f"`{c}`") for c in columns]))


def ensemble_buckets(df, scores, weight="token_length", store=True):
    """Thresholds from the data itself, then integer bins and their row maximum.

    `df` should be slim (id, weight, scores): it is stored once, because scoring
    is the costly part and the thresholds need passes of their own. Pass
    store=False for a table that is stored already.
    """
    stored = cut_lineage(df) if store else df
    binned = digitize(stored, scores, thresholds(stored, scores, weight))
    return ensemble_max(binned, [f"{s}-int" for s in scores])


def bucket_counts(df, bucket="ensemble-max-int"):
    return df.groupBy(F.col(f"`{bucket}`").alias("bucket")).agg(F.count("*").alias("n"))


