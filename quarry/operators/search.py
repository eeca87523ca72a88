"""Model search: stratified folds, tree-structured Parzen proposals, median pruning, and linear support-vector regression.

The search keeps a short list of trials in the driver; every fit and every score is a Spark job
over the whole table.
"""

import math
import random
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.plans.prefix import hash_rank


def with_folds(df, folds, seed, key, stratify, out="fold"):
    """Add a fold number, 0 to folds - 1: every class is dealt in turn in a seeded order of its rows.

    So the folds' shares of a class differ by at most one row. Nulls in `stratify` are a class.
    """
    ranked = hash_rank(df, key, seed, by=[stratify], out="_rank")
    return ranked.withColumn(out, ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")


@dataclass
class Trial:
    """Parameters, the scores of the folds that were run, and whether the rest was pruned."""

    params: dict
    scores: list = field(default_factory=list)
    pruned: bool = False

    @property
    def value(self):
        return sum(self.scores) / len(self.scores)


class ParzenSearch:
    """Proposes parameters that are likely among good trials and unlikely among bad ones.

    `ranges`: name -> (low, high) searched on a logarithmic scale, (low, high, "int"), or a list.
    The first `startup` proposals are random. Later the best `gamma` of the trials are the good
    ones; each group is a mixture of kernels around its values and of the whole range, and of
    `candidates` draws from the good mixture the one with the highest ratio is proposed.
    """

    def __init__(self, ranges, seed=42, startup=10, gamma=0.25, candidates=24):
        self.ranges, self.random = ranges, random.Random(seed)
        self.startup, self.gamma, self.candidates = startup, gamma, candidates

    def propose(self, trials):
        done = [t for t in trials if not t.pruned]
        if len(done) < self.startup:
            return {name: self.drawn(choice) for name, choice in self.ranges.items()}
        ranked = sorted(done, key=lambda t: -t.value)
        count = max(1, math.ceil(self.gamma * len(ranked)))
        # Pruned trials count as bad.
        bad = ranked[count:] + [t for t in trials if t.pruned]
        return {name: self.better(name, choice, ranked[:count], bad) for name, choice in self.ranges.items()}

    def drawn(self, choice):
        if isinstance(choice, list):
            return self.random.choice(choice)
        low, high = choice[0], choice[1]
        return self.rounded(choice, low * (high / low) ** self.random.random())

    def rounded(self, choice, value):
        value = min(max(value, choice[0]), choice[1])
        return round(value) if len(choice) > 2 else value

    def better(self, name, choice, good, bad):
        good, bad = [t.params[name] for t in good], [t.params[name] for t in bad]
        if isinstance(choice, list):
            weight = lambda values, c: (values.count(c) + 1) / (len(values) + len(choice))
            drawn = [self.random.choice([*good, self.random.choice(choice)]) for _ in range(self.candidates)]
            return max(drawn, key=lambda c: weight(good, c) / weight(bad, c))
        low, high = math.log(choice[0]), math.log(choice[1])
        good, bad = [[math.log(v) for v in values] for values in (good, bad)]
        drawn = []
        for _ in range(self.candidates):
            pick = self.random.randrange(len(good) + 1)
            width = self.width(good, low, high)
            drawn.append(self.random.uniform(low, high) if pick == len(good) else self.random.gauss(good[pick], width))
        drawn = [min(max(x, low), high) for x in drawn]
        density = lambda values, x: self.density(values, x, low, high)
        best = max(drawn, key=lambda x: density(good, x) / density(bad, x))
        return self.rounded(choice, math.exp(best))

    def width(self, values, low, high):
        return max((high - low) / (1 + len(values)), 1e-3 * (high - low))

    def density(self, values, x, low, high):
        """A kernel around every value and one uniform part."""
        width = self.width(values, low, high)
        kernels = sum(math.exp(-(((x - v) / width) ** 2) / 2) / (width * math.sqrt(2 * math.pi)) for v in values)
        return (kernels + 1 / (high - low)) / (len(values) + 1)


def below_median(trial, trials, warmup):
    """Whether a trial's mean so far lies below the median of the others' means over as many folds."""
    steps = len(trial.scores)
    others = sorted(sum(t.scores[:steps]) / steps for t in trials if len(t.scores) >= steps)
    if len(others) < warmup:
        return False
    middle = len(others) // 2
    median = others[middle] if len(others) % 2 else (others[middle - 1] + others[middle]) / 2
    return trial.value < median


def cross_validated_search(df, fit, score, ranges, folds=3, trials=20, seed=42, fold="fold", startup=10, warmup=5):
    """(best parameters, trials): `fit(train, params)` gives a model and `score(model, test)` a number, the more the better.

    `df` has its fold numbers in `fold`. A trial that lies below the median of the earlier ones
    after a fold is pruned, that is its other folds are not run.
    """
    search, done = ParzenSearch(ranges, seed, startup), []
    for _ in range(trials):
        trial = Trial(search.propose(done))
        for number in range(folds):
            model = fit(df.filter(F.col(fold) != number), trial.params)
            trial.scores.append(float(score(model, df.filter(F.col(fold) == number))))
            if number + 1 < folds and below_median(trial, done, warmup):
                trial.pruned = True
                break
        done.append(trial)
    best = max((t for t in done if not t.pruned), key=lambda t: t.value)
    return best.params, done


# --- linear support-vector regression ---------------------------------------------


class LinearSVR:
    """Linear regression with the epsilon-insensitive loss.

    Minimises |w|^2 / (2 C n) + mean(max(0, |y - w x - b| - epsilon)). Every step is one pass:
    partitions add up their part of the loss and its gradient, a few numbers reach the driver,
    and limited-memory quasi-Newton steps are taken there. The corner of the loss is rounded
    off over a width that falls through `WIDTHS` times the mean deviation of the labels.
    """

    WIDTHS, STEPS, MEMORY = (1.0, 0.1, 0.01), 30, 8

    def __init__(self, C=1.0, epsilon=0.0, features="features", label="label", tolerance=1e-6):
        self.C, self.epsilon, self.features, self.label, self.tolerance = C, epsilon, features, label, tolerance

    def fit(self, df):
        entries = vector_to_array(self.features) if df.schema[self.features].dataType.typeName() == "vectorudt" else F.col(self.features)
        rows = df.select(entries.cast("array<double>").alias("x"), F.col(self.label).cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
        first = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d"), F.avg("y").alias("mean")).first()
        if not first["n"]:
            raise ValueError("no row has features and a label")
        spread = rows.agg(F.avg(F.abs(F.col("y") - F.lit(first["mean"])))).first()[0] or 1.0
        point = np.zeros(first["d"] + 1)
        point[-1] = first["mean"]
        for width in self.WIDTHS:
            point = quasi_newton(lambda p: self.objective(rows, first["n"], p, width * spread), point, self.STEPS, self.MEMORY, self.tolerance)
        return LinearSVRModel(point[:-1], float(point[-1]), self.features)

    def objective(self, rows, n, point, width):
        """(value, gradient) at (w, b), one pass over the rows."""
        epsilon = self.epsilon

        def run(batches):
            total = np.zeros(len(point) + 1)
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                    value, slope = rounded_loss(batch.column("y").to_numpy() - x @ point[:-1] - point[-1], epsilon, width)
                    total += np.concatenate([[value.sum()], -(slope @ x), [-slope.sum()]])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["place", "part"])

        sums = rows.mapInArrow(run, "place int, part double").groupBy("place").agg(F.sum("part").alias("total")).collect()
        total = np.array([r["total"] for r in sorted(sums, key=lambda r: r["place"])]) / n
        scale = 1 / (self.C * n)
        gradient = total[1:] + scale * np.append(point[:-1], 0.0)
        return total[0] + scale * float(point[:-1] @ point[:-1]) / 2, gradient


def rounded_loss(residual, epsilon, width):
    """max(0, |r| - epsilon) with a parabola of that width at the corner, and its slope."""
    over = np.abs(residual) - epsilon
    inside = np.clip(over, 0, width)
    value = np.where(over > width, over - width / 2, inside * inside / (2 * width))
    return value, np.sign(residual) * inside / width


def quasi_newton(objective, point, steps, memory, tolerance):
    """Limited-memory BFGS with backtracking; the point where the gradient or the gain is small."""
    value, gradient = objective(point)
    pairs = []
    for _ in range(steps):
        if np.abs(gradient).max() <= tolerance:
            break
        direction, saved = gradient.copy(), []
        for s, y in reversed(pairs):
            a = (s @ direction) / (s @ y)
            direction -= a * y
            saved.append(a)
        if pairs:
            s, y = pairs[-1]
            direction *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(saved)):
            direction += s * (a - (y @ direction) / (s @ y))
        slope, size = float(gradient @ direction), 1.0 if pairs else 1 / max(1.0, float(np.abs(gradient).sum()))
        for _ in range(25):
            there = point - size * direction
            new_value, new_gradient = objective(there)
            if new_value <= value - 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = there - point, new_gradient - gradient
        if s @ y > 1e-12:
            pairs = [*pairs[1 - memory :], (s, y)]
        gain, point, value, gradient = value - new_value, there, new_value, new_gradient
        if gain <= tolerance * 1e-2 * max(abs(value), 1e-12):
            break
    return point


class LinearSVRModel:
    """Weights and intercept; `transform` adds the prediction."""

    def __init__(self, weights, intercept, features):
        self.weights, self.intercept, self.features = weights, intercept, features

    def transform(self, df):
        entries = vector_to_array(self.features) if df.schema[self.features].dataType.typeName() == "vectorudt" else F.col(self.features)
        weights = F.array(*[F.lit(float(w)) for w in self.weights])
        product = F.aggregate(F.zip_with(entries.cast("array<double>"), weights, lambda a, b: a * b), F.lit(self.intercept), lambda s, x: s + x)
        return df.withColumn("prediction", product)
