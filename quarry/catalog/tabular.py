"""Tabular modelling over customers, orders and parts."""

from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, table
from quarry.operators import search, tabular as tab
from quarry.plans.checkpoints import cut_lineage

CATALOG = Catalog()


def gaps(spark, folder):
    """Customers with some missing balances and segments."""
    c = table(spark, folder, "customer")
    return c.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"),
        "c_nationkey",
    )


GAPS = """g AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance,
 CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment, c_nationkey FROM customer)"""


@CATALOG.add(
    "profile",
    f"""WITH {GAPS}, n AS (SELECT count(*) AS n, count(*) - count(balance) AS b, count(*) - count(segment) AS s FROM g)
    SELECT 'c_custkey' AS "column", 'numeric' AS kind, 0 AS missing, n AS n_rows, 4 AS n_columns FROM n UNION ALL SELECT 'balance', 'numeric', b, n, 4 FROM n
    UNION ALL SELECT 'segment', 'categorical', s, n, 4 FROM n UNION ALL SELECT 'c_nationkey', 'numeric', 0, n, 4 FROM n""",
)
def _(spark, folder):
    return tab.profile(gaps(spark, folder))


@CATALOG.add(
    "profile_totals",
    f"WITH {GAPS} SELECT count(*) AS n_rows, 4 AS n_columns, 2 * count(*) - count(balance) - count(segment) AS missing, 3 AS numeric, 1 AS categorical FROM g",
)
def _(spark, folder):
    return tab.profile_totals(gaps(spark, folder))


@CATALOG.add(
    "target_profile_classes",
    """WITH c AS (SELECT c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 1), t AS (SELECT v, n FROM c ORDER BY n DESC, v LIMIT 3)
    SELECT count(*) AS n_distinct, min(v) AS min, max(v) AS max, (SELECT string_agg(v || '=' || n, ',' ORDER BY n DESC, v) FROM t) AS top_classes, 'classification' AS task FROM c""",
)
def _(spark, folder):
    return tab.target_profile(table(spark, folder, "customer"), "c_mktsegment")


@CATALOG.add(
    "target_profile_numbers",
    "SELECT count(DISTINCT o_totalprice) AS n_distinct, min(o_totalprice) AS min, max(o_totalprice) AS max, NULL::VARCHAR AS top_classes, 'regression' AS task FROM orders",
)
def _(spark, folder):
    return tab.target_profile(table(spark, folder, "orders"), "o_totalprice")


@CATALOG.add(
    "prepare_numeric",
    f"""WITH {GAPS}, m AS (SELECT c_custkey, coalesce(balance, (SELECT median(balance) FROM g)) AS b, c_nationkey::DOUBLE AS k FROM g)
    SELECT c_custkey, round((b - avg(b) OVER ()) / stddev_pop(b) OVER (), 6) AS balance, round((k - avg(k) OVER ()) / stddev_pop(k) OVER (), 6) AS c_nationkey FROM m""",
)
def _(spark, folder):
    out = tab.prepare_numeric(gaps(spark, folder).drop("segment"), ["balance", "c_nationkey"])
    return out.select("c_custkey", F.round("balance", 6).alias("balance"), F.round("c_nationkey", 6).alias("c_nationkey"))


@CATALOG.add(
    "medians",
    "SELECT 'o_totalprice' AS \"column\", median(o_totalprice) AS median FROM orders UNION ALL SELECT 'o_custkey', median(o_custkey) FROM orders",
)
def _(spark, folder):
    return tab.medians(table(spark, folder, "orders"), ["o_totalprice", "o_custkey"])


@CATALOG.add(
    "prepare_categorical",
    f"""WITH {GAPS}, top AS (SELECT segment FROM g WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)
    SELECT c_custkey, coalesce(segment, (SELECT segment FROM top)) AS segment FROM g""",
)
def _(spark, folder):
    return tab.prepare_categorical(gaps(spark, folder), ["segment"]).select("c_custkey", "segment")


@CATALOG.add(
    "one_hot",
    f"WITH {GAPS} SELECT c_custkey, coalesce((segment = 'BUILDING')::INTEGER, 0) AS segment_BUILDING, coalesce((segment = 'MACHINERY')::INTEGER, 0) AS segment_MACHINERY FROM g",
)
def _(spark, folder):
    out = tab.one_hot_columns(gaps(spark, folder), "segment", ["BUILDING", "MACHINERY"])
    return out.select("c_custkey", "segment_BUILDING", "segment_MACHINERY")


@CATALOG.add(
    "train_test_split_stratified",
    """WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('42:' || c_custkey), c_custkey) AS r,
      count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)
    SELECT c_custkey, c_mktsegment, CASE WHEN r <= round(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM r""",
)
def _(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return tab.train_test_split(df, 0.2, 42, "c_custkey", "c_mktsegment")


@CATALOG.add(
    "train_test_split_plain",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) AS r, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, CASE WHEN r <= round(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM r""",
)
def _(spark, folder):
    return tab.train_test_split(table(spark, folder, "orders").select("o_orderkey"), 0.2, 42, "o_orderkey")


def parts(spark, folder):
    """Split customers for a class target and parts for a number target."""
    c = tab.train_test_split(table(spark, folder, "customer"), 0.2, 42, "c_custkey", "c_mktsegment")
    return c.filter("part = 'train'"), c.filter("part = 'test'")


def price_rows(spark, folder):
    p = tab.train_test_split(table(spark, folder, "part"), 0.2, 42, "p_partkey")
    return p.filter("part = 'train'"), p.filter("part = 'test'")


@CATALOG.add("train_classifiers")
def _(spark, folder):
    train, test = parts(spark, folder)
    rows, _, _ = tab.train_models(train, test, ["c_acctbal", "c_nationkey"], [], "c_mktsegment", "classification")
    return rows


@CATALOG.add("train_regressors")
def _(spark, folder):
    train, test = price_rows(spark, folder)
    rows, _, _ = tab.train_models(train, test, ["p_partkey", "p_size"], ["p_type"], "p_retailprice", "regression")
    return rows


FOLDS = """f AS (SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal,
  ((row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('42:' || c_custkey), c_custkey) - 1) % 3)::INTEGER AS fold FROM customer)"""


@CATALOG.add("stratified_folds", f"WITH {FOLDS} SELECT c_custkey, c_mktsegment, fold FROM f")
def _(spark, folder):
    return search.with_folds(table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), 3, 42, "c_custkey", "c_mktsegment")


STRENGTHS = [0.0, 10.0, 100.0, 1000.0]


@CATALOG.add(
    "search_shrinkage",
    f"""WITH {FOLDS}, s AS (SELECT unnest({STRENGTHS}) AS strength), k AS (SELECT unnest(range(3)) AS fold),
    n AS (SELECT k.fold, c_nationkey, sum(c_acctbal)::DOUBLE AS t, count(*) AS n FROM k JOIN f ON f.fold <> k.fold GROUP BY ALL),
    g AS (SELECT k.fold, avg(c_acctbal) AS m FROM k JOIN f ON f.fold <> k.fold GROUP BY ALL),
    e AS (SELECT strength, f.fold, -avg(power(c_acctbal - coalesce((t + strength * m) / nullif(n + strength, 0), m), 2)) AS v
          FROM f JOIN g USING (fold) LEFT JOIN n USING (fold, c_nationkey), s GROUP BY ALL),
    c AS (SELECT strength, avg(v) AS v FROM e GROUP BY ALL)
    SELECT strength, round(v, 4) AS score, (SELECT count(*) FROM f WHERE fold = 0) AS first_fold FROM c ORDER BY v DESC LIMIT 1""",
)
def _(spark, folder):
    """How far a nation's mean balance is drawn to that of all, chosen by cross-validation; the score is minus the squared error."""
    rows = cut_lineage(search.with_folds(table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", F.col("c_acctbal").cast("double").alias("y")), 3, 42, "c_custkey", "c_mktsegment"))

    def fit(train, params):
        mean = train.agg(F.avg("y")).first()[0]
        sums = train.groupBy("c_nationkey").agg(F.sum("y").alias("t"), F.count("*").alias("n"))
        return mean, sums.select("c_nationkey", F.try_divide(F.col("t") + params["strength"] * mean, F.col("n") + params["strength"]).alias("guess"))

    def score(model, test):
        mean, guesses = model
        error = F.col("y") - F.coalesce("guess", F.lit(mean))
        return -test.join(guesses, "c_nationkey", "left").agg(F.avg(error * error)).first()[0]

    best, trials = search.cross_validated_search(rows, fit, score, {"strength": STRENGTHS}, trials=12, startup=8)
    value = max(t.value for t in trials if not t.pruned)
    found = rows.filter("fold = 0").agg(F.count("*").alias("first_fold"))
    return found.select(F.lit(best["strength"]).alias("strength"), F.round(F.lit(value), 4).alias("score"), "first_fold")


@CATALOG.add("tune_and_predict")
def _(spark, folder):
    """Model-based search over a logistic regression, then class probabilities for the test rows."""
    train, test = parts(spark, folder)
    prepared = tab.Pipeline(stages=tab.features(["c_acctbal", "c_nationkey"], [], "c_mktsegment", True)).fit(train)
    rows = prepared.transform(train).select("c_custkey", "c_mktsegment", "features", "label")
    model, _ = tab.tune(
        rows, tab.LogisticRegression(maxIter=100), {"regParam": (1e-3, 1.0), "elasticNetParam": [0.0, 0.5, 1.0]}, "c_custkey", "c_mktsegment", trials=5,
    )
    classes = prepared.stages[-1].labels
    return tab.predict(model, prepared.transform(test), classes, keep=["c_custkey"])


@CATALOG.add(
    "classification_metrics",
    """WITH p AS (SELECT c_mktsegment AS l, CASE WHEN c_custkey % 3 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS p FROM customer),
    k AS (SELECT DISTINCT l AS c FROM p UNION SELECT DISTINCT p FROM p),
    s AS (SELECT c, (SELECT count(*) FROM p WHERE l = c) AS a, (SELECT count(*) FROM p WHERE p.p = c) AS g, (SELECT count(*) FROM p WHERE l = c AND p.p = c) AS h FROM k)
    SELECT round(sum(h)::DOUBLE / sum(a), 9) AS accuracy, round(sum(a * 2 * h::DOUBLE / (a + g)) / sum(a), 9) AS f1_weighted FROM s""",
)
def _(spark, folder):
    df = table(spark, folder, "customer").withColumn(
        "guess", F.when(F.col("c_custkey") % 3 == 0, "BUILDING").otherwise(F.col("c_mktsegment"))
    )
    out = tab.classification_metrics(df, "guess", "c_mktsegment")
    return out.select(F.round("accuracy", 9).alias("accuracy"), F.round("f1_weighted", 9).alias("f1_weighted"))


@CATALOG.add(
    "regression_metrics",
    """WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)
    SELECT round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg((p - y) * (p - y))), 4) AS rmse, round(avg(abs(p - y)), 4) AS mae FROM p""",
)
def _(spark, folder):
    df = table(spark, folder, "lineitem").withColumn("guess", F.col("l_quantity") * 1500)
    out = tab.regression_metrics(df, "guess", "l_extendedprice")
    return out.select(F.round("r2", 6).alias("r2"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"))


@CATALOG.add(
    "class_distribution",
    "SELECT o_orderstatus AS prediction, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM orders) * 100, 2) AS percent FROM orders GROUP BY 1",
)
def _(spark, folder):
    return tab.class_distribution(table(spark, folder, "orders").select(F.col("o_orderstatus").alias("prediction")))


@CATALOG.add(
    "value_summary",
    "SELECT round(avg(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS std, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders",
)
def _(spark, folder):
    out = tab.value_summary(table(spark, folder, "orders"), "o_totalprice")
    return out.select(F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max")


def log_lines(spark, folder):
    """Events as experiment lines; every eleventh line is cut off."""
    metric = F.when(F.col("event_id") % 2 == 0, "accuracy").otherwise("rmse")
    line = F.concat(
        F.lit('{"task": "'), "event_type", F.lit('", "model": "m'), F.col("user_id").cast("string"), F.lit('", "metrics": {"'), metric,
        F.lit('": '), F.col("value").cast("string"), F.lit('}, "timestamp": '), F.col("event_id").cast("string"),
        F.when(F.col("event_id") % 11 == 0, "").otherwise("}"),
    )
    return table(spark, folder, "events").select(line.alias("value"))


@CATALOG.add(
    "best_experiments",
    """(SELECT 'accuracy' AS metric, 'm' || user_id AS model, event_id::DOUBLE AS timestamp FROM events WHERE event_id % 11 <> 0 AND event_id % 2 = 0 ORDER BY value DESC, event_id LIMIT 1)
    UNION ALL (SELECT 'rmse', 'm' || user_id, event_id FROM events WHERE event_id % 11 <> 0 AND event_id % 2 = 1 ORDER BY value, event_id LIMIT 1)""",
)
def _(spark, folder):
    log = tab.parse_experiments(log_lines(spark, folder))
    one = lambda m: tab.best_experiment(log, m).select(F.lit(m).alias("metric"), "model", "timestamp")
    return one("accuracy").unionByName(one("rmse"))


@CATALOG.add(
    "recent_experiments",
    "SELECT event_type AS task, event_id::DOUBLE AS timestamp FROM events WHERE event_id % 11 <> 0 ORDER BY event_id DESC LIMIT 10",
)
def _(spark, folder):
    return tab.recent_experiments(tab.parse_experiments(log_lines(spark, folder))).select("task", "timestamp")


@CATALOG.add("count_experiments", "SELECT count(*) AS n FROM events WHERE event_id % 11 <> 0")
def _(spark, folder):
    return tab.parse_experiments(log_lines(spark, folder)).agg(F.count("*").alias("n"))


@CATALOG.add(
    "replicate_rows",
    """WITH r AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS p, count(*) OVER () AS n FROM supplier)
    SELECT s_suppkey, unnest(range(greatest(0, ceil((3333 - p)::DOUBLE / n)::BIGINT)))::INTEGER AS copy FROM r""",
)
def _(spark, folder):
    return tab.replicate_to(table(spark, folder, "supplier").select("s_suppkey"), 3333, "s_suppkey")
