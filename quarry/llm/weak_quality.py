"""Text quality from weak labels: heuristic labellers, EM over their votes, a hashed linear scorer.

1. Labellers look at simple measures of a text and vote good, bad, or abstain. One pass over
   all texts counts the vote patterns, combined before the shuffle. At most
   3 ** len(LABELLERS) patterns reach the driver, whatever the size of the corpus.
2. Expectation maximisation on the pattern counts estimates how often each labeller gives each
   vote for good and for bad texts, and how common good texts are; no true labels are used.
   It gives every pattern a posterior probability of good.
3. On a bounded sample (at most `SAMPLE_ROWS` distinct rows with words, those with the smallest
   hashes of id and text) a logistic regression of Spark's ML library learns the posteriors from hashed features: byte trigrams, four-grams of
   character classes, and buckets of the measures.
4. All texts are scored row by row with the weights (`FEATURES` numbers in the task).
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import functions as F

from quarry.llm.common import stored
from quarry.llm.near_duplicates import mix, plain_texts, text_slices, word_hashes

SAMPLE_ROWS = 8000
FEATURE_BITS = 15
FEATURES = 1 << FEATURE_BITS
ROUNDS = 50
SCALE = 10.0
WINDOW = 2000
GOOD, ABSTAIN, BAD = 2, 1, 0

# Frequent function words of some languages.
FUNCTION_WORDS = (
    "the of and to in a is that it for was on with as be at by he from this or an are not but "
    "der die und das ist von mit den im ein eine zu des auf nicht für dem sich "
    "de la le et les des un une que en du dans il est pas pour qui "
    "el los del las y se por con una su al lo como más"
)


def byte_texts(texts):
    """(bytes, ends) of an Arrow string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def hash_words(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    with np.errstate(over="ignore"):
        return np.unique(word_hashes(data, np.array([len(data)]))[0])


FUNCTION_HASHES = hash_words(FUNCTION_WORDS.split())
IS_LETTER = np.zeros(256, bool)
IS_LETTER[65:91] = IS_LETTER[97:123] = IS_LETTER[128:] = True
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[33:128] = True
IS_SYMBOL[48:58] = IS_SYMBOL[65:91] = IS_SYMBOL[97:123] = False
# Classes of bytes: lower, upper, digit, space, line break, other letters; symbols stay themselves.
CLASSES = np.arange(256, dtype=np.int64)
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58], CLASSES[128:] = 1, 2, 3, 6


def sums(values, ends):
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[np.concatenate([[0], ends])])


def measures(data, ends):
    """Shares per text: symbols, upper, distinct, top, repeats, lines, function; and words, word_length.

    The share of distinct words falls with length, so that of a text of more than `WINDOW` words
    is the mean over windows of that many words (the last one ends with the text).
    """
    size = np.maximum(np.diff(np.concatenate([[0], ends])), 1)
    with np.errstate(over="ignore"):
        hashes, before = word_hashes(data, ends) if len(data) else (np.zeros(0, np.uint64), np.zeros(len(ends), np.int64))
    words = np.diff(np.concatenate([[0], before]))
    known = np.isin(hashes, FUNCTION_HASHES)
    again = np.concatenate([[False], hashes[1:] == hashes[:-1]]) if len(hashes) else known
    distinct, top, lines = np.ones(len(ends)), np.zeros(len(ends)), np.zeros(len(ends))
    first = byte = 0
    for k, (last, end) in enumerate(zip(before.tolist(), ends.tolist())):
        if last > first:
            counts = np.unique(hashes[first:last], return_counts=True)[1]
            distinct[k], top[k] = len(counts) / (last - first), counts.max() / (last - first)
            if last - first > WINDOW:
                starts = [*range(first, last - WINDOW, WINDOW), last - WINDOW]
                distinct[k] = np.mean([len(np.unique(hashes[at : at + WINDOW])) for at in starts]) / WINDOW
            rows = [r for r in data[byte:end].tobytes().split(b"\n") if r.strip()]
            lines[k] = 1 - len(set(rows)) / max(len(rows), 1)
        first, byte = last, end
    letters = np.maximum(sums(IS_LETTER[data], ends), 1)
    some = np.maximum(words, 1)
    return {
        "symbols": sums(IS_SYMBOL[data], ends) / size, "upper": sums((data >= 65) & (data <= 90), ends) / letters,
        "distinct": distinct, "top": top, "repeats": sums(again, before) / some, "lines": lines, "function": sums(known, before) / some,
        "words": words, "word_length": letters / some,
    }


def vote(good, bad):
    return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN))


LABELLERS = {
    "symbols": lambda m: vote(m["symbols"] < 0.05, m["symbols"] > 0.08),
    "upper": lambda m: vote(m["upper"] < 0.06, m["upper"] > 0.25),
    "distinct": lambda m: np.where(m["words"] < 20, ABSTAIN, vote(m["distinct"] > 0.5, m["distinct"] < 0.3)),
    "top": lambda m: np.where(m["words"] < 20, ABSTAIN, vote(m["top"] < 0.085, m["top"] > 0.1)),
    "repeats": lambda m: np.where(m["words"] < 20, ABSTAIN, vote(m["repeats"] < 0.03, m["repeats"] > 0.1)),
    "lines": lambda m: np.where(m["words"] < 20, ABSTAIN, vote(m["lines"] < 0.1, m["lines"] > 0.3)),
    "function": lambda m: np.where(m["words"] < 20, ABSTAIN, vote(m["function"] > 0.06, m["function"] < 0.02)),
    "word_length": lambda m: vote((m["word_length"] > 3.5) & (m["word_length"] < 7), (m["word_length"] < 2.5) | (m["word_length"] > 9)),
}


def patterns(found):
    """One number per text for the votes of all labellers."""
    out = np.zeros(len(found["words"]), np.int64)
    for labeller in LABELLERS.values():
        out = out * 3 + labeller(found)
    return out


def votes_of(pattern):
    """The votes behind a pattern number, in the order of `LABELLERS`."""
    return np.array([(pattern // 3**k) % 3 for k in reversed(range(len(LABELLERS)))])


def pattern_counts(docs, text="text"):
    """{pattern: number of texts} over all rows."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                found, counts = np.unique(patterns(measures(*byte_texts(plain_texts(part)))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], names=["pattern", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "pattern long, n long")
    return {r["pattern"]: r["n"] for r in rows.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}


class VoteModel:
    """P(good), and P(vote | bad or good) of every labeller among the votes it gives.

    Abstaining says nothing: its chance is 1 for both classes.
    """

    def __init__(self, prior, chances):
        self.prior, self.chances = prior, chances

    def posterior(self, votes):
        """P(good | votes) for rows of votes."""
        columns = np.arange(votes.shape[1])
        logs = np.log(self.chances)
        score = [np.log(p) + logs[c, columns, votes].sum(axis=1) for c, p in enumerate((1 - self.prior, self.prior))]
        return 1 / (1 + np.exp(np.clip(score[0] - score[1], -700, 700)))

    def accuracies(self):
        """Share of right votes among votes given, per labeller."""
        right = (1 - self.prior) * self.chances[0, :, BAD] + self.prior * self.chances[1, :, GOOD]
        return dict(zip(LABELLERS, right.tolist()))


def fit_votes(counts, rounds=ROUNDS):
    """Expectation maximisation from {pattern: count}; it starts at the balance of the votes."""
    votes = np.array([votes_of(p) for p in sorted(counts)]).reshape(-1, len(LABELLERS))
    weights = np.array([counts[p] for p in sorted(counts)], float)
    balance = (votes == GOOD).sum(axis=1) - (votes == BAD).sum(axis=1)
    good = np.where(balance > 1, 0.95, np.where(balance < 0, 0.05, 0.4))
    model = VoteModel(0.5, np.full((2, len(LABELLERS), 3), 1 / 3))
    for _ in range(rounds):
        chances = np.empty((2, len(LABELLERS), 3))
        for c, share in enumerate((1 - good, good)):
            for v in (BAD, GOOD):
                chances[c, :, v] = ((votes == v) * (weights * share)[:, None]).sum(axis=0) + 0.5
        chances[:, :, [BAD, GOOD]] /= chances[:, :, [BAD, GOOD]].sum(axis=2, keepdims=True)
        chances[:, :, ABSTAIN] = 1
        prior = ((weights * good).sum() + 1) / (weights.sum() + 2)
        model = VoteModel(prior, chances)
        good = model.posterior(votes) if len(votes) else good
    return model


def hashed_features(data, ends, found):
    """(feature numbers per kind, weight per byte, bucket features): each kind sums to `SCALE` per text."""
    size = np.diff(np.concatenate([[0], ends]))
    shift = np.uint64(64 - FEATURE_BITS)
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.int64)
    kinds = []
    for width, codes, base in ((3, low, 256), (4, CLASSES[data], 128)):
        grams = np.full(len(data), width, np.int64)
        for k in range(width):
            ahead = np.zeros(len(data), np.int64)
            ahead[: len(data) - k] = codes[k:]
            grams = grams * base + ahead
        with np.errstate(over="ignore"):
            kinds.append((mix(grams.view(np.uint64)) >> shift).astype(np.int64))
    buckets = [np.digitize(found[name], edges) + 16 * k for k, (name, edges) in enumerate((
        ("symbols", (0.03, 0.05, 0.08, 0.15)), ("upper", (0.03, 0.06, 0.12, 0.25)), ("distinct", (0.1, 0.3, 0.5, 0.65)),
        ("top", (0.07, 0.1, 0.2, 0.4)), ("lines", (0.1, 0.3, 0.6)), ("function", (0.02, 0.06, 0.1, 0.2)), ("word_length", (2.5, 3.5, 5, 7, 9)),
    ))]
    with np.errstate(over="ignore"):
        slots = (mix(np.array(buckets).astype(np.uint64) + np.uint64(1 << 40)) >> shift).astype(np.int64)
    return kinds, np.repeat(SCALE / np.maximum(size, 1), size), slots


def sample(docs, rows, doc_id="doc_id", text="text"):
    """(text) of at most `rows` rows with words: those with the smallest hashes of id and text.

    Rows that repeat both the id and the text count once. A cut of the hashes by the estimated
    number of distinct rows comes first, so that ranking sees few numbers and no texts.
    """
    number = F.xxhash64(F.col(doc_id).cast("string"), F.col(text).cast("string"))
    with_words = docs.filter(F.col(text).cast("string").rlike("[^\\x20\\x09-\\x0D]"))
    numbered = with_words.select(number.alias("number"), F.col(text).alias("text"))
    total = numbered.agg(F.approx_count_distinct("number", 0.02)).first()[0]
    share = min(1.0, (1.5 * rows + 100) / max(total, 1))
    cut = numbered.filter(F.col("number") <= F.lit(int(2**64 * share) - 2**63 - 1).cast("bigint"))
    last = cut.select("number").distinct().orderBy("number").limit(rows).agg(F.max("number")).first()[0]
    chosen = cut.filter(F.col("number") <= F.lit(last).cast("bigint"))
    return chosen.groupBy("number").agg(F.first("text").alias("text")).select("text")


def sample_features(docs, model, rows, doc_id="doc_id", text="text"):
    """(numbers, values, good) of a bounded sample: sparse features and the posterior."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                data, ends = byte_texts(plain_texts(part))
                found = measures(data, ends)
                chances = model.posterior(np.array([votes_of(p) for p in patterns(found)]).reshape(-1, len(LABELLERS)))
                kinds, weights, slots = hashed_features(data, ends, found)
                numbers, values, first = [], [], 0
                for k, end in enumerate(ends.tolist()):
                    every = np.concatenate([*(kind[first:end] for kind in kinds), slots[:, k]])
                    load = np.concatenate([*(weights[first:end] for _ in kinds), np.full(len(slots), 1.0)])
                    place, at = np.unique(every, return_inverse=True)
                    numbers.append(place)
                    values.append(np.bincount(at, load))
                    first = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64())), pa.array(chances)], names=["numbers", "values", "good"]
                )

    return sample(docs, rows, doc_id, text).mapInArrow(run, "numbers array<long>, values array<double>, good double")


def fit_scorer(features):
    """(weights, intercept) of a logistic regression on soft labels."""
    vector = F.udf(lambda numbers, values: SparseVector(FEATURES, numbers, values), VectorUDT())
    both = F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("good").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("good")).alias("weight"))
    ))
    rows = features.select(vector("numbers", "values").alias("features"), both.alias("side")).select("features", "side.*").filter("weight > 0.01")
    if rows.select("label").distinct().count() < 2:
        return np.zeros(FEATURES), None
    fitted = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=30).fit(rows)
    return fitted.coefficients.toArray(), float(fitted.intercept)


def train(docs, sample_rows=SAMPLE_ROWS, text="text", doc_id="doc_id"):
    """(vote model, weights, intercept) for the rows of `docs`."""
    model = fit_votes(pattern_counts(docs, text))
    weights, intercept = fit_scorer(stored(sample_features(docs, model, sample_rows, doc_id, text)))
    return model, weights, intercept


def score(docs, trained, doc_id="doc_id", text="text", least=0.5):
    """(doc_id, score, weak_label, keep) of every row.

    `weak_label` is the posterior of the votes, `score` the scorer's probability of good, and
    `keep` says score >= `least`. A null, empty or blank text has score 0 and is not kept. If
    the corpus shows only one class (an empty one too), the score is the posterior. Repeated
    rows each get their row; other columns are ignored.
    """
    model, weights, intercept = trained
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ids = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                data, ends = byte_texts(plain_texts(part))
                found = measures(data, ends)
                chances = model.posterior(np.array([votes_of(p) for p in patterns(found)]).reshape(-1, len(LABELLERS)))
                scores = chances
                if intercept is not None:
                    kinds, shares, slots = hashed_features(data, ends, found)
                    line = np.concatenate([[0.0], np.cumsum(sum(weights[kind] for kind in kinds) * shares)]) if len(data) else np.zeros(1)
                    sums_ = np.diff(line[np.concatenate([[0], ends])])
                    scores = 1 / (1 + np.exp(-np.clip(sums_ + weights[slots].sum(axis=0) + intercept, -700, 700)))
                scores = np.where(found["words"] > 0, scores, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores), pa.array(chances), pa.array(scores >= least)], names=["doc_id", "score", "weak_label", "keep"]
                )

    return rows.mapInArrow(run, f"doc_id {ids}, score double, weak_label double, keep boolean")
