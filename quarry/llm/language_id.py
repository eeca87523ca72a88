"""Language identification with segmentation-marginalised unigram models.

A text is cut into words: runs of letters, lower-cased, each with a front mark, and cut after
every `WORD_CHARS` characters. A
language gives every piece of the fixed public vocabulary a probability. The probability of
a word is the sum over all its segmentations into pieces, by the forward algorithm; that of
a text is the product over its words. A character that no piece spells costs `UNKNOWN`.

Probabilities are learned by expectation maximisation from a bounded sample of labelled rows
(`SAMPLE_ROWS` per language, chosen by a hash of the id): the expected uses of pieces come
from the forward-backward algorithm. A language is a group of its own, so languages train in
parallel, and only the pieces that a language uses come to the driver. The number of languages
has no limit of its own; a model of more than `MOST_NUMBERS` numbers is refused.

Scoring is row-local: no shuffle. A task scores each distinct word of a batch once, all words
together, position by position, for a block of at most `BLOCK_LANGUAGES` languages at a time.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from quarry.llm.common import broadcast_up_to, free_name, stored
from quarry.llm.pieces import MARK, VOCABULARY, vocabulary
from quarry.plans.checkpoints import drop_stored

SAMPLE_ROWS = 1000
ROUNDS = 3
WORD_CHARS = 40
UNKNOWN = 1e-7
SMOOTHING = 0.1
BLOCK_WORDS = 8192
BLOCK_LANGUAGES = 64
MOST_NUMBERS = 20_000_000
CACHED_WORDS = 100_000
BROADCAST_ROWS = 100_000
LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"


def marked_words(text):
    """The words of a text, marked; none if it has no letter."""
    found = [MARK + w for w in LETTERS.findall(text.lower())]
    if any(len(w) > WORD_CHARS for w in found):
        found = [w[k : k + WORD_CHARS] for w in found for k in range(0, len(w), WORD_CHARS)]
    return found


class Lattice:
    """The vocabulary as a trie over character classes, and the edges of blocks of words."""

    def __init__(self, pieces):
        self.pieces = pieces
        alphabet = sorted(set("".join(pieces)))
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        nodes, ends = [{}], [-1]
        for number, piece in enumerate(pieces):
            at = 0
            for c in piece:
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nodes[at][c]
            ends[at] = number
        self.ends = np.array(ends, np.int32)
        # A sorted list of (node, class) pairs; dense tables would be gigabytes for large alphabets.
        keys = [(at * (len(alphabet) + 1) + int(self.classes[ord(c)]), to) for at, kids in enumerate(nodes) for c, to in kids.items()]
        keys.sort()
        self.keys = np.array([k for k, _ in keys], np.int64)
        self.targets = np.array([t for _, t in keys], np.int32)
        self.width = len(alphabet) + 1
        self.dense = None
        if len(nodes) * self.width <= 8_000_000:
            self.dense = np.zeros(len(nodes) * self.width, np.int32)
            self.dense[self.keys] = self.targets

    def child(self, nodes, classes):
        """The next nodes; 0 where there is none."""
        keys = nodes.astype(np.int64) * self.width + classes
        if self.dense is not None:
            found = self.dense[keys]
        else:
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = np.where(self.keys[at] == keys, self.targets[at], 0)
        return np.where(classes > 0, found, 0)

    def edges(self, words):
        """For every start position: (end position, word rows, piece numbers) of all pieces there."""
        lengths = np.array([len(w) for w in words])
        codes = np.zeros((len(words), int(lengths.max()) + 1), np.int32)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        rows = np.repeat(np.arange(len(words)), lengths)
        codes[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = self.classes[flat]
        out = []
        for start in range(int(lengths.max())):
            active, here = np.flatnonzero(lengths > start), []
            nodes, end = np.zeros(len(active), np.int32), start
            while len(active) and end < codes.shape[1] - 1:
                nodes = self.child(nodes, codes[active, end])
                going = nodes > 0
                active, nodes = active[going], nodes[going]
                end += 1
                piece = self.ends[nodes]
                hit = piece >= 0
                if hit.any():
                    here.append((end, active[hit], piece[hit]))
            out.append(here)
        return lengths, out


def forward(lengths, edges, probabilities):
    """Scaled forward values [position, word, language] and the log of what was scaled away."""
    count, languages = len(lengths), probabilities.shape[1]
    alpha = np.zeros((len(edges) + 1, count, languages))
    alpha[0] = 1
    for start, here in enumerate(edges):
        # A character alone always goes on, so that every word has a probability.
        going = np.flatnonzero(lengths > start)
        alpha[start + 1, going] += alpha[start, going] * UNKNOWN
        for end, rows, pieces in here:
            alpha[end, rows] += alpha[start, rows] * probabilities[pieces]
    return alpha


def word_scores(words, lattice, probabilities):
    """log P(word) per language: [word, language]."""
    out = np.empty((len(words), probabilities.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    step = max(1, 4 * BLOCK_WORDS // max(probabilities.shape[1], 4))
    for at in range(0, len(words), step):
        block = order[at : at + step]
        lengths, edges = lattice.edges([words[i] for i in block])
        alpha = forward(lengths, edges, probabilities)
        out[block] = np.log(alpha[lengths, np.arange(len(block))])
    return out


def expected_uses(words, weights, lattice, probabilities):
    """Expected uses of every piece in the words: forward-backward for one language."""
    uses = np.zeros(len(lattice.pieces))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for at in range(0, len(words), BLOCK_WORDS):
        block = order[at : at + BLOCK_WORDS]
        lengths, edges = lattice.edges([words[i] for i in block])
        alpha = forward(lengths, edges, probabilities)[:, :, 0]
        rows = np.arange(len(block))
        beta = np.zeros_like(alpha)
        beta[lengths, rows] = weights[block] / alpha[lengths, rows]
        for start in range(len(edges) - 1, -1, -1):
            going = np.flatnonzero(lengths > start)
            beta[start, going] += beta[start + 1, going] * UNKNOWN
            for end, members, pieces in edges[start]:
                flow = beta[end, members] * probabilities[pieces, 0]
                beta[start, members] += flow
                np.add.at(uses, pieces, alpha[start, members] * flow)
    return uses


def training_rows(docs):
    """(lang, text) of rows with a text, an id, and a language, that are not held out."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    return labelled.filter(~is_held_out(F.col("doc_id")))


def is_held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_per_language(rows, most):
    """At most `most` rows per language: those with the smallest hashes of their ids.

    The share of each language is cut by a hash bound first, so that ranking sees few rows.
    """
    counts = rows.groupBy("lang").agg(F.count("*").alias("_rows"))
    counted = rows.join(broadcast_up_to(counts, BROADCAST_ROWS), "lang")
    number = F.xxhash64(F.col("doc_id").cast("string"))
    near = counted.filter(F.pmod(number, F.lit(1 << 30)) < 1.5 * most / F.col("_rows") * (1 << 30))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(number, F.lit(1 << 30)), number, "text"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= most).select("lang", "text")


def count_words(sample):
    """(lang, word, n) of a sample: distinct marked words with their counts."""

    def run(batches):
        for batch in batches:
            counts = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for word in marked_words(text):
                    counts[lang, word] = counts.get((lang, word), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["lang", "word", "n"],
            )

    words = sample.mapInArrow(run, "lang string, word string, n long")
    return words.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def starting_probabilities(pieces):
    """Longer pieces are likelier than the product of their characters: 1 / 100 per character."""
    start = np.array([100.0 ** -min(len(p), 8) for p in pieces])
    return start / start.sum()


class Block:
    """Some languages: the pieces that they use and their probabilities [piece, language]."""

    def __init__(self, pieces, probabilities):
        self.pieces, self.probabilities = pieces, probabilities
        self.trie = None

    def __getstate__(self):
        return (self.pieces, self.probabilities)

    def __setstate__(self, state):
        self.__init__(*state)

    def lattice(self):
        if self.trie is None:
            self.trie = Lattice(self.pieces)
        return self.trie


class Model:
    """Languages by name, in blocks, and the number of letters of their pieces."""

    def __init__(self, languages, blocks):
        self.languages, self.blocks = languages, blocks
        self.letters = len({c for b in blocks for p in b.pieces for c in p})


def piece_uses(words, rounds, path):
    """(lang, piece number, uses) after `rounds` of expectation maximisation, one group per language.

    A group holds the distinct words of at most `SAMPLE_ROWS` texts.
    """

    lattices = []  # one per task, which must not outlive it in a reused worker

    def run(table):
        if not lattices:
            lattices.append(Lattice(list(vocabulary(path).ids)))
        lattice = lattices[0]
        texts, weights = table["word"].to_pylist(), table["n"].to_numpy().astype(float)
        probabilities = starting_probabilities(lattice.pieces)[:, None]
        for _ in range(rounds):
            uses = expected_uses(texts, weights, lattice, probabilities)
            probabilities = ((uses + 1e-12) / (uses + 1e-12).sum())[:, None]
        used = np.flatnonzero(uses > 1e-3)
        lang = pa.array([table["lang"][0].as_py()] * len(used), pa.string())
        return pa.table([lang, pa.array(used, pa.int64()), pa.array(uses[used])], names=["lang", "piece", "uses"])

    return words.groupBy("lang").applyInArrow(run, "lang string, piece long, uses double")


def train(docs, sample_rows=SAMPLE_ROWS, rounds=ROUNDS, path=VOCABULARY):
    """The model of all languages that label training rows of (doc_id, text, lang)."""
    sample = sample_per_language(training_rows(docs), sample_rows)
    uses = stored(piece_uses(count_words(sample), rounds, path))
    if uses.count() > MOST_NUMBERS:
        raise ValueError(f"the model has more than {MOST_NUMBERS} numbers")
    found = uses.orderBy("lang", "piece").toArrow()
    drop_stored(uses)
    names, pieces = found["lang"].to_numpy(), list(vocabulary(path).ids)
    languages, place = np.unique(names.astype(str), return_inverse=True)
    numbers, weights = found["piece"].to_numpy(), found["uses"].to_numpy()
    blocks = []
    for first in range(0, len(languages), BLOCK_LANGUAGES):
        mine = (place >= first) & (place < first + BLOCK_LANGUAGES)
        used, row = np.unique(numbers[mine], return_inverse=True)
        dense = np.full((len(used), min(BLOCK_LANGUAGES, len(languages) - first)), SMOOTHING)
        dense[row, place[mine] - first] += weights[mine]
        blocks.append(Block([pieces[i] for i in used], dense / dense.sum(axis=0)))
    return Model(languages.tolist(), blocks)


def block_totals(lists, block, cache):
    """log P of every list of words: [text, language]; `cache` maps words that were scored before to their row."""
    fresh = sorted({w for words in lists for w in words} - cache["place"].keys())
    if fresh:
        scores = word_scores(fresh, block.lattice(), block.probabilities)
        if len(cache["place"]) > CACHED_WORDS:  # the cache only saves time
            known = sorted({w for words in lists for w in words} & cache["place"].keys())
            cache["rows"] = cache["rows"][[cache["place"][w] for w in known]]
            cache["place"] = {w: k for k, w in enumerate(known)}
        first = len(cache["place"])
        cache["place"].update({w: first + k for k, w in enumerate(fresh)})
        cache["rows"] = np.concatenate([cache["rows"], scores])
    place, rows = cache["place"].__getitem__, cache["rows"]
    out = np.zeros((len(lists), rows.shape[1]))
    for k, words in enumerate(lists):
        if words:
            out[k] = rows[np.fromiter(map(place, words), np.int64, len(words))].sum(axis=0)
    return out


def new_cache(block):
    return {"place": {}, "rows": np.zeros((0, block.probabilities.shape[1]))}


def score_texts(texts, model, caches=None):
    """(language, score, evidence) per text; `caches` keeps scored words of a model with one block.

    The evidence is the mean over the characters of what the best language's log probability
    is above that of a background model, in which all letters of the model's pieces are alike.
    """
    lists = [marked_words(t) if t else [] for t in texts]
    keep = caches is not None and len(model.blocks) == 1
    if keep and not caches:
        caches.append(new_cache(model.blocks[0]))
    parts = [block_totals(lists, b, caches[0] if keep else new_cache(b)) for b in model.blocks]
    totals = np.concatenate(parts, axis=1) if parts else None
    for k, words in enumerate(lists):
        if not words or totals is None:
            yield UNDETERMINED, 0.0, None
            continue
        total = totals[k]
        best = int(total.argmax())
        evidence = total[best] / sum(map(len, words)) + math.log(model.letters)
        yield model.languages[best], float(1 / np.exp(total - total[best]).sum()), float(evidence)


def identify(docs, model, text="text", out=("lang_pred", "score")):
    """`docs` with the columns `out`: the predicted language, its score and, if named, its evidence, row by row.

    The score is the posterior of the predicted language under equal priors, 0 to 1. A text
    without a letter, or null, gets 'und' with score 0 and no evidence, as does every text if the
    model knows no language. Ties go to the language that comes first by name. Input columns with
    these names are replaced.
    """
    kept = [c for c in docs.columns if c not in out]
    docs = docs.select(*kept)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    kinds = [pa.string(), pa.float64(), pa.float64()][: len(out)]

    def run(batches):
        caches = []
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                found = list(score_texts(part.column(text).to_pylist(), model, caches))
                columns = [*part.columns, *[pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *out])

    added = ", ".join(f"`{name}` {kind}" for name, kind in zip(out, ("string", "double", "double")))
    return docs.mapInArrow(run, f"{fields}, {added}")


def keep_known_languages(docs, model, languages=None, least_evidence=0.0, text="text"):
    """The rows of `docs` whose text is in one of `languages` (all that the model knows, if not given).

    A text without letters is rejected, and so is one that its best language explains worse than
    the background model does, per character by less than `least_evidence` nats: it is in no
    language that was learned. Unlike the score, this does not depend on the text's length, so
    short clean texts stay. If the model knows no language, all texts with letters stay.
    """
    if not model.languages:
        return docs.filter(F.udf(lambda t: bool(t and marked_words(t)), "boolean")(F.col(text)))
    names = [free_name(docs, c) for c in ("lang_pred", "score", "evidence")]
    found = identify(docs, model, text, names).filter(F.col(names[2]) >= least_evidence)
    if languages:
        found = found.filter(F.col(names[0]).isin(*languages))
    return found.select(*docs.columns)
