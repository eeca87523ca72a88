"""Tabular modelling: profile, preparation, training, scoring, experiment log."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from quarry.operators.search import LinearSVR, cross_validated_search, with_folds
from quarry.plans.checkpoints import cut_lineage
from quarry.plans.prefix import first_reaching, hash_rank
from quarry.plans.skew import join_groups

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
# Fixed value: metrics where more is better.
HIGHER = ("accuracy", "f1", "f1_weighted", "r2", "precision", "recall")


def numeric_columns(df):
    return [c for c, t in df.dtypes if t.startswith(NUMBERS)]


def profile(df):
    """(column, kind, missing, n_rows, n_columns): one pass, one row per column."""
    numbers = set(numeric_columns(df))
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit("numeric" if c in numbers else "categorical").alias("kind"),
            F.col(c).alias("missing"),
        )
        for c in df.columns
    ]
    listed = counts.select("_rows", F.explode(F.array(*rows)).alias("r"))
    return listed.select(
        "r.column", "r.kind", "r.missing", F.col("_rows").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def profile_totals(df):
    return profile(df).agg(
        F.max("n_rows").alias("n_rows"),
        F.max("n_columns").alias("n_columns"),
        F.sum("missing").alias("missing"),
        F.count_if(F.col("kind") == "numeric").alias("numeric"),
        F.count_if(F.col("kind") == "categorical").alias("categorical"),
    )


def target_profile(df, target):
    """Distinct values, range, the three most frequent classes when there are at most
    ten, and the task: numeric targets with over 20 values mean regression."""
    numeric = target in numeric_columns(df)
    counts = df.groupBy(F.col(target).alias("v")).agg(F.count("*").alias("n")).filter("v is not null")
    top = counts.orderBy(F.desc("n"), "v").limit(3)
    names = top.agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("v").cast("string").alias("v")))),
                lambda x: F.concat(x["v"], F.lit("="), (-x["m"]).cast("string")),
            ),
            ",",
        ).alias("t")
    ).scalar()
    base = counts.agg(F.count("*").alias("n_distinct"), F.min("v").alias("min"), F.max("v").alias("max"))
    return base.withColumn("_top", names).select(
        "n_distinct", "min", "max",
        F.when(F.col("n_distinct") <= 10, F.col("_top")).alias("top_classes"),
        F.when(F.lit(numeric) & (F.col("n_distinct") > 20), "regression").otherwise("classification").alias("task"),
    )


def medians(df, columns):
    """(column, median): exact, the mean of the two middle values for even counts.

    Equal values are counted first; only the buckets of the middle values are ranked. A
    column without values has no row.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    counts = (
        df.select(F.explode(cells).alias("x")).select("x.column", "x.v").filter("v is not null")
        .groupBy("column", "v").agg(F.count("*").alias("w"))
    )
    middle = {
        "low": lambda run, total: run >= F.floor((total + 1) / 2),
        "high": lambda run, total: run >= F.floor(total / 2) + 1,
    }
    return first_reaching(counts, "column", "v", "w", middle).groupBy("column").agg(F.avg("value").alias("median"))


def numeric_stats(df, columns):
    """(column, median, mean, std): mean and population deviation after imputation."""
    middle = medians(df, columns)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    sums = df.select(F.explode(cells).alias("x")).groupBy("x.column").agg(
        F.count("*").alias("n"), F.count("x.v").alias("k"), F.coalesce(F.avg("x.v"), F.lit(0.0)).alias("m"),
        F.coalesce(F.var_pop("x.v"), F.lit(0.0)).alias("var"),
    )
    joined = sums.join(middle, "column")
    k, n, m, med = F.col("k"), F.col("n"), F.col("m"), F.col("median")
    mean = (m * k + med * (n - k)) / n
    # Within-group variance plus the spread of the two groups (present, imputed).
    var = (F.col("var") * k + k * (m - mean) ** 2 + (n - k) * (med - mean) ** 2) / n
    return joined.select("column", "median", mean.alias("mean"), F.sqrt(var).alias("std"))


def prepare_numeric(df, columns, stats=None):
    """Median imputation and standard scaling. `stats` has one row per column and is
    read as one scalar map."""
    stats = numeric_stats(df, columns) if stats is None else stats
    lookup = stats.agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("median", "mean", "std")))).alias("m")
    ).scalar()
    ready = df.withColumn("_stats", lookup)

    def scale(c):
        s = F.col("_stats")[c]
        return (F.coalesce(F.col(c).cast("double"), s["median"]) - s["mean"]) / F.when(s["std"] > 0, s["std"]).otherwise(1.0)

    return ready.withColumns({c: scale(c) for c in columns}).drop("_stats")


def most_frequent(df, column):
    """Most frequent value, the lowest on ties, from pre-aggregated counts."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    return counts.agg(F.min_by("v", F.struct((-F.col("n")).alias("n"), "v")).alias("v"))


def prepare_categorical(df, columns):
    """Most-frequent imputation."""
    return df.withColumns({c: F.coalesce(F.col(c), most_frequent(df, c).scalar()) for c in columns})


def one_hot_columns(df, column, categories):
    """One 0/1 column per category of the training data; unseen values are all zero."""
    hits = {f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in categories}
    return df.withColumns(hits)


def features(numeric, categorical, label=None, classify=False):
    """Stages that assemble a `features` vector (and an index `label` for classes)."""
    stages = []
    if categorical:
        indexed, hot = [f"{c}_index" for c in categorical], [f"{c}_hot" for c in categorical]
        stages += [
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep"),
        ]
    else:
        hot = []
    stages.append(VectorAssembler(inputCols=[*numeric, *hot], outputCol="features", handleInvalid="keep"))
    if classify:
        stages.append(StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"))
    return stages


def train_test_split(df, test, seed, key, stratify=None):
    """Seeded split column `part`: round(n * test) rows to test, per class if asked.

    Ranks are taken inside hash buckets of a class, so a class with most of the
    rows is not ranked in one task.
    """
    by = [stratify] if stratify else []
    ranked = hash_rank(df, key, seed, by=by, out="_rank")
    if stratify:
        sizes = df.groupBy(stratify).agg(F.count("*").alias("n"))
        sized = join_groups(ranked, sizes, [stratify], [key])
    else:
        sized = ranked.withColumn("n", df.agg(F.count("*").alias("n")).scalar())
    part = F.when(F.col("_rank") <= F.round(F.col("n") * F.lit(test)), "test").otherwise("train")
    return sized.withColumn("part", part).drop("_rank", "n")


def classifiers():
    return {
        "logistic_regression": LogisticRegression(maxIter=100, regParam=0.01),
        "random_forest": RandomForestClassifier(numTrees=100, maxDepth=10, seed=42),
        "linear_svm": OneVsRest(classifier=LinearSVC(maxIter=100, regParam=0.01)),
    }


def regressors(rows):
    """Ridge regression has the penalty 1 on the sum of squares, that is 1 / rows on their mean."""
    return {
        "ridge_regression": LinearRegression(elasticNetParam=0.0, regParam=1 / max(rows, 1)),
        "random_forest": RandomForestRegressor(numTrees=100, maxDepth=10, seed=42),
        "linear_svr": LinearSVR(),
    }


def train_models(train, test, numeric, categorical, label, task):
    """Fit three models and return (model, metrics...) best first, and the fitted models.

    Classifiers are ranked by weighted F1, regressors by R2. The prepared rows are stored in
    order of a hash, so that a fit does not depend on how the input was split.
    """
    classify = task == "classification"
    prepared = Pipeline(stages=features(numeric, categorical, label, classify)).fit(train)
    fit_on, score_on = prepared.transform(train), prepared.transform(test)
    if not classify:
        fit_on, score_on = [d.withColumn("label", F.col(label).cast("double")) for d in (fit_on, score_on)]
    order = F.xxhash64(F.col("features").cast("string"), "label")
    fit_on = cut_lineage(fit_on.select("features", "label").sort(order))
    score_on = cut_lineage(score_on.select("features", "label"))
    # Closures of some fits carry their session along, and a session that has observed a
    # query can't be serialised. So the models work in a session of their own.
    own = train.sparkSession.newSession()
    fit_on, score_on = [own.read.schema(t.schema).parquet(t.stored_path) for t in (fit_on, score_on)]
    models, rows = {}, None
    for name, estimator in (classifiers() if classify else regressors(fit_on.count())).items():
        models[name] = estimator.fit(fit_on)
        # Stored predictions: metrics read them several times, and their plans stay small.
        scored = cut_lineage(models[name].transform(score_on).select("prediction", "label"))
        one = (classification_metrics if classify else regression_metrics)(scored, "prediction", "label")
        one = one.select(F.lit(name).alias("model"), "*")
        rows = one if rows is None else rows.unionByName(one)
    best = F.desc("f1_weighted") if classify else F.desc("r2")
    return rows.orderBy(best, "model"), prepared, models


def classification_metrics(df, prediction, label):
    """Accuracy and weighted F1 from the table of (label, prediction) counts."""
    table = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))
    entries = F.array(
        F.struct(F.col("l").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("guessed"),
                 F.lit(0).cast("bigint").alias("hit")),
    )
    per_class = table.select(F.explode(entries).alias("e")).groupBy("e.c").agg(
        F.sum("e.actual").alias("actual"), F.sum("e.guessed").alias("guessed"), F.sum("e.hit").alias("hit")
    )
    f1 = F.when(
        F.col("actual") + F.col("guessed") > 0, 2 * F.col("hit") / (F.col("actual") + F.col("guessed"))
    ).otherwise(0.0)
    return per_class.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("f1_weighted"),
    )


def regression_metrics(df, prediction, label):
    """R2, RMSE and MAE in one pass."""
    error = F.col(prediction) - F.col(label)
    sums = df.agg(
        F.count("*").alias("n"), F.sum(error * error).alias("sse"), F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("var"),
    )
    return sums.select(
        (1 - F.col("sse") / (F.col("var") * F.col("n"))).alias("r2"),
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        "mae",
    )


def tune(train, estimator, ranges, key, stratify, trials=5, folds=3, seed=42, metric=None, classify=True):
    """Model-based search with stratified cross-validation: (best model refitted on all rows, trials).

    `ranges`: parameter -> (low, high) on a logarithmic scale, (low, high, "int"), or a list to
    choose from. Folds deal the rows of every class of `stratify` in a seeded order of `key`.
    """
    evaluator = (
        MulticlassClassificationEvaluator(metricName=metric or "weightedFMeasure")
        if classify
        else RegressionEvaluator(metricName=metric or "r2")
    )
    dealt = cut_lineage(with_folds(train, folds, seed, key, stratify))
    # As for the models above, fits work in a session of their own.
    dealt = train.sparkSession.newSession().read.schema(dealt.schema).parquet(dealt.stored_path)

    def fit(rows, params):
        return estimator.copy({estimator.getParam(p): v for p, v in params.items()}).fit(rows)

    best, done = cross_validated_search(dealt, fit, lambda model, rows: evaluator.evaluate(model.transform(rows)), ranges, folds, trials, seed)
    return fit(dealt, best), done


def predict(model, df, classes=None, keep=()):
    """Prediction and, for classifiers, one probability column per class."""
    scored = model.transform(df)
    columns = [*keep, "prediction"]
    if classes and "probability" in scored.columns:
        values = vector_to_array("probability")
        columns += [F.get(values, F.lit(i)).alias(f"probability_{c}") for i, c in enumerate(classes)]
    return scored.select(*columns)


def class_distribution(df, prediction="prediction"):
    counts = df.groupBy(prediction).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("_total", total).withColumn(
        "percent", F.round(F.col("n") / F.col("_total") * 100, 2)
    ).drop("_total")


def value_summary(df, prediction="prediction"):
    return df.agg(
        F.avg(prediction).alias("mean"), F.stddev_pop(prediction).alias("std"),
        F.min(prediction).alias("min"), F.max(prediction).alias("max"),
    )


EXPERIMENT = (
    "task string, dataset_shape array<bigint>, target string, model string, metrics map<string,double>,"
    " best_params map<string,string>, timestamp double, date string, _corrupt string"
)


def parse_experiments(lines, column="value"):
    """Experiment records from JSON lines; blank and corrupt lines are skipped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = lines.filter(F.length(F.trim(column)) > 0).select(F.from_json(column, EXPERIMENT, options).alias("e"))
    return parsed.filter("e is not null and e._corrupt is null").select("e.*").drop("_corrupt")


def load_experiments(spark, path):
    return parse_experiments(spark.read.text(path))


def best_experiment(experiments, metric):
    """Best by a metric; whether more is better follows from its name. The earliest wins ties."""
    score = F.col("metrics")[metric]
    rank = F.struct((-score if metric.lower() in HIGHER else score).alias("s"), F.col("timestamp").alias("t"))
    record = F.struct(*experiments.columns)
    best = experiments.filter(score.isNotNull()).agg(F.min_by(record, rank).alias("e"))
    return best.filter("e is not null").select("e.*")


def recent_experiments(experiments, n=10):
    return experiments.orderBy(F.desc_nulls_last("timestamp")).limit(n)


def replicate_to(df, n, order):
    """Repeat the table until it has n rows (the last repetition from the top)."""
    from quarry.plans.prefix import position

    total = df.agg(F.count("*").alias("n")).scalar()
    placed = position(df, order, out="_position").withColumn("_total", total)
    copies = F.ceil((F.lit(n) - F.col("_position")) / F.col("_total")).cast("int")
    return (
        placed.withColumn("_copies", copies)
        .filter(F.col("_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
        .drop("_position", "_total", "_copies")
    )
