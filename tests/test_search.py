"""Folds, Parzen search, pruning and linear support-vector regression."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import search


def test_folds_are_stratified(spark):
    df = spark.range(1000).withColumn("c", F.when(F.col("id") < 900, "a").when(F.col("id") < 990, "b"))
    got = search.with_folds(df, 4, 7, "id", "c").groupBy("c", "fold").count().collect()
    for name, rows in (("a", 900), ("b", 90), (None, 10)):
        sizes = [r["count"] for r in got if r["c"] == name]
        assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1 and len(sizes) == 4


def test_search_beats_random_draws():
    """A smooth peak: after the start most proposals lie closer to it than random ones do."""
    value = lambda p: -abs(np.log(p["a"]) - np.log(0.03)) - (p["b"] != "y") - abs(p["n"] - 20) / 40
    ranges = {"a": (1e-4, 10.0), "b": ["x", "y", "z"], "n": (5, 80, "int")}
    later, drawn = [], []
    for seed in range(6):
        tpe, trials = search.ParzenSearch(ranges, seed), []
        for _ in range(50):
            trials.append(search.Trial(tpe.propose(trials)))
            trials[-1].scores.append(value(trials[-1].params))
        assert all(1e-4 <= t.params["a"] <= 10 and 5 <= t.params["n"] <= 80 and isinstance(t.params["n"], int) for t in trials)
        drawn += [t.value for t in trials[:10]]
        later += [t.value for t in trials[30:]]
    assert np.mean(later) > np.mean(drawn) + 1


def test_same_seed_same_proposals():
    ranges = {"a": (0.1, 10.0)}
    one, two = ([search.ParzenSearch(ranges, 5).propose([]) for _ in range(2)] for _ in range(2))
    assert one == two


def test_median_pruning():
    trials = [search.Trial({}, [v, v]) for v in (1.0, 2.0, 3.0, 4.0, 5.0)]
    assert search.below_median(search.Trial({}, [2.9]), trials, 5)
    assert not search.below_median(search.Trial({}, [3.0]), trials, 5)
    assert not search.below_median(search.Trial({}, [0.0]), trials[:4], 5)


def test_cross_validated_search_prunes(spark):
    df = spark.range(30).withColumn("fold", (F.col("id") % 3).cast("int"))
    runs = []

    def fit(train, params):
        runs.append(params["x"])
        return params["x"]

    best, trials = search.cross_validated_search(df, fit, lambda m, _: -abs(m - 3), {"x": [1, 2, 3, 4, 9]}, trials=25, startup=8)
    assert best == {"x": 3} and any(t.pruned for t in trials) and len(runs) < 75
    assert all(len(t.scores) == 3 for t in trials if not t.pruned)


@pytest.mark.parametrize("C,epsilon", [(1.0, 0.0), (0.05, 0.5)])
def test_svr_against_plain_solver(spark, C, epsilon):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1000, 4))
    y = x @ np.array([2.0, -1.0, 0.0, 0.5]) + 3 + rng.standard_t(2, size=1000)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "features array<double>, label double").repartition(5)
    df = df.unionByName(spark.createDataFrame([(None, 1.0), ([1.0, 0.0, 0.0, 0.0], None)], df.schema))
    model = search.LinearSVR(C=C, epsilon=epsilon).fit(df)

    def loss(w, b):
        return w @ w / (2 * C * len(x)) + np.maximum(np.abs(y - x @ w - b) - epsilon, 0).mean()

    point, best = np.zeros(5), np.inf
    for step in range(1, 20_001):
        residual = y - x @ point[:4] - point[4]
        sign = np.sign(residual) * (np.abs(residual) > epsilon)
        gradient = np.append(point[:4] / (C * len(x)) - (sign[:, None] * x).mean(axis=0), -sign.mean())
        point = point - gradient / np.sqrt(step)
        best = min(best, loss(point[:4], point[4]))
    assert loss(model.weights, model.intercept) <= best * 1.005
    rows = model.transform(df.filter("features IS NOT NULL")).collect()
    assert np.allclose([r["prediction"] for r in rows], [np.dot(r["features"], model.weights) + model.intercept for r in rows])
    with pytest.raises(ValueError):
        search.LinearSVR().fit(df.filter("false"))


def test_corner_of_the_loss():
    rng = random.Random(1)
    for _ in range(200):
        r, width = rng.uniform(-3, 3), rng.uniform(0.01, 1)
        (value,), (slope,) = search.rounded_loss(np.array([r]), 0.5, width)
        (above,), _ = search.rounded_loss(np.array([r + 1e-6]), 0.5, width)
        assert abs(value - max(abs(r) - 0.5, 0)) <= width / 2 + 1e-12 and abs((above - value) / 1e-6 - slope) < 1e-3
