"""Edge cases and brute-force versions of the llm operators on small data."""

import itertools
import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quarry.llm import decontamination as dc
from quarry.llm import language_id as li
from quarry.llm import main_text as mt
from quarry.llm import near_duplicates as nd
from quarry.llm import neighbours as nn
from quarry.llm import secret_scan as ss
from quarry.llm import sentence_pieces as sp
from quarry.llm import weak_quality as wq
from quarry.llm.common import attach, stored
from quarry.llm.page_blocks import leaf_blocks
from quarry.llm.pieces import MARK, vocabulary
from tests.llm.test_queries import plain_groups


def words_of(rng, n, vocabulary=40):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_attach_slices_hot_keys(spark):
    members = spark.range(5000).selectExpr("id", "if(id < 3000, 1, id) AS key")
    groups = stored(members.groupBy("key").count().withColumnRenamed("count", "n").filter("n > 1").selectExpr("key", "n", "key * 10 AS tag"))
    rows = attach(members, groups, ["key"], ["id"]).collect()
    assert len(rows) == 5000 and all(r["tag"] == (10 if r["id"] < 3000 else None) for r in rows)


# Decontamination

def plain_report(docs, items, window=13):
    out, find = {}, lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    for key, text in docs:
        w, hit, ids = find(text), set(), set()
        for name, item in items:
            x = find(item)
            size = min(window, len(x))
            for s in range(len(x) - size + 1) if x else ():
                for k in range(len(w) - size + 1):
                    if w[k : k + size] == x[s : s + size]:
                        hit.update(range(k, k + size))
                        ids.add(str(name))
        out[key] = (len(w), len(hit), len(ids), bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_contamination_against_plain_python(spark):
    rng = random.Random(5)
    items = [(i, words_of(rng, rng.choice((1, 4, 13, 14, 30)), 60)) for i in range(12)] + [(100, ""), (101, None), (3, "w1 w2 w3")]
    docs = [(0, None), (1, ""), (2, "!!!"), (3, items[3][1]), (4, "W1 w2... W3")]
    for k in range(5, 60):
        parts = [words_of(rng, rng.randrange(60), 60)]
        if k % 3 == 0:
            x = rng.choice(items[:12])[1].split()
            cut = rng.randrange(len(x))
            parts += [" ".join(x[cut:]), words_of(rng, 5, 60), " ".join(x), " ".join(x)]
        docs.append((k, " ".join(parts)))
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS term", "1 AS pos", "2 AS item_key")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS doc_id")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in dc.contamination_report(d, b).collect()}
    assert got == plain_report(docs, items)
    kept = dc.remove_contaminated(d, b)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {k for k, v in got.items() if not v[3]}
    assert dc.contamination_report(d, b.filter("false")).filter("contaminated").count() == 0
    assert dc.contamination_report(d.filter("false"), b).count() == 0


def test_repeated_and_null_ids(spark):
    text = "a1 b2 c3 d4"
    d = spark.createDataFrame([(1, text), (1, text), (1, "other"), (None, text)], "doc_id long, text string")
    b = spark.createDataFrame([(7, text), (7, text)], "item_id long, text string")
    rows = dc.contamination_report(d, b).collect()
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in rows) == [(0, 4), (1, 0), (1, 4), (1, 4)]


def test_proximity(spark):
    d = spark.createDataFrame([(1, "x y a q q b q c"), (2, "a " + "z " * 30 + "b c"), (3, "c b a")], "doc_id long, text string")
    items = stored(dc.prepare_items(spark.createDataFrame([(9, "a b c")], "item_id long, text string")))
    index = dc.build_index(d, items)
    near = dc.proximity_matches(index, items, dc.term_counts(index), span=8)
    assert {(r["doc_id"], r["item_id"]) for r in near.collect()} == {(1, "9"), (3, "9")}


# Near duplicates

def test_groups_against_plain_python(spark):
    """A group around a base that is not there: stars miss links, the residue finds them."""
    rng = random.Random(3)
    texts, base = {}, [f"b{k}" for k in range(150)]
    for k in range(60):
        copy = list(base)
        for at in rng.sample(range(0, 150, 6), rng.choice((1, 1, 2, 3))):
            copy[at] = f"e{rng.randrange(40)}"
        texts[k] = " ".join(copy)
    for k in range(60, 90):
        texts[k] = " ".join(base[:100]) + " " + words_of(rng, 40, 1000)
    texts |= {90: None, 91: "", 92: " \t\n", 93: "one two", 94: "ONE\ntwo", 95: "two one", 96: texts[0], 97: texts[0].upper(), 98: "é É", 99: "É é"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 AS band", "'s' AS shingle", "0 AS n")
    for percent in (80, 85):
        got = nd.near_duplicate_groups(docs, percent).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_groups(texts, percent)
    kept = nd.keep_one_per_group(docs.unionByName(docs), 85)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, (_, c) in plain_groups(texts, 85).items() if k == c)
    assert nd.near_duplicate_groups(docs.filter("false")).count() == 0


def test_rows_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (None, "alone"), (None, None)], "doc_id long, text string")
    got = sorted(((r["component_id"] or -1), r["kept"]) for r in nd.near_duplicate_groups(docs).collect())
    assert got == [(-1, True), (-1, True), (4, False), (4, True)]
    assert nd.keep_one_per_group(docs).count() == 4


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    one = rng.integers(0, 1 << 62, 1).astype(np.uint64)
    table = nd.sketches([base[:3000], base[300:3300], one, base[:7]])
    assert (table < np.uint64(1 << 63)).all()
    assert abs((table[0] == table[1]).mean() - 2700 / 3300) < 0.1
    assert len(np.unique(nd.sketches([one])[0] >> np.uint64(54))) > 1
    for percent in (80, 85, 90):
        rows = nd.band_rows(percent)
        assert (1 - (percent / 100) ** rows) ** (nd.COORDINATES // rows) <= nd.MISS


# Language identification and pieces

def test_forward_sums_all_segmentations():
    pieces, words = ["a", "b", "ab", "ba", "aba", "▁", "▁a"], ["▁abab", "▁b", "▁xab", "aba"]
    rng = np.random.default_rng(2)
    chances = rng.random((len(pieces), 2)) / 7

    def total(word, lang):
        if not word:
            return 1.0
        known = sum(chances[k, lang] * total(word[len(p) :], lang) for k, p in enumerate(pieces) if word.startswith(p))
        return known + li.UNKNOWN * total(word[1:], lang)

    got = li.word_scores(words, li.Lattice(pieces), chances)
    assert np.allclose(got, [[math.log(total(w, k)) for k in (0, 1)] for w in words])
    uses = li.expected_uses(["▁ab"], np.array([3.0]), li.Lattice(["▁", "a", "b", "ab"]), np.full((4, 1), 0.1))
    paths = {("▁", "a", "b"): 0.1**3, ("▁", "ab"): 0.1**2}
    assert np.allclose(uses[3], 3 * paths["▁", "ab"] / sum(paths.values()), rtol=1e-3)


def test_language_edge_cases(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choices(("the", "and", "house"), k=20)), "en") for k in range(30)]
    rows += [(k, " ".join(rng.choices(("der", "und", "haus"), k=20)), "de") for k in range(30, 60)]
    odd = [(100, None, None), (101, "", "en"), (102, "123 !?", None), (103, "x" * 5000, None), (104, "漢字", None), (None, "und der", "xx")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").selectExpr("*", "'k' AS score")
    model = li.train(docs)
    assert model.languages == ["de", "en"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in li.identify(docs, model).collect()}
    assert all(got[k][0] == lang for k, _, lang in rows) and got[None][0] == "de"
    assert got[100] == got[101] == got[102] == ("und", 0.0) and got[103][0] in ("de", "en")
    kept = li.keep_known_languages(docs, model)
    assert kept.columns == docs.columns and {100, 101, 102}.isdisjoint(r["doc_id"] for r in kept.collect())
    nothing = li.train(docs.filter("false"))
    assert {r["lang_pred"] for r in li.identify(docs, nothing).collect()} == {"und"}


def test_short_texts_and_unlabelled_rows_are_kept(spark):
    """Texts that fit three languages alike score below 0.5; only those without letters go."""
    rows = [(k, " ".join([w] * 9 + ["no"]), x) for k, (w, x) in enumerate([("haus", "de"), ("house", "en"), ("casa", "es")] * 12)]
    short = [(100, "no", None), (101, "no no", None), (102, "12 !", None), (103, None, None)]
    docs = spark.createDataFrame(rows + short, "doc_id long, text string, lang string")
    model = li.train(docs)
    assert [r["score"] < 0.5 for r in li.identify(docs.filter("doc_id IN (100, 101)"), model).collect()] == [True, True]
    want = [k for k, _, _ in rows] + [100, 101]
    assert sorted(r["doc_id"] for r in li.keep_known_languages(docs, model).collect()) == want
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r["doc_id"] for r in li.keep_known_languages(bare, li.train(bare)).collect()) == want


def test_expected_uses_against_all_segmentations():
    rng = np.random.default_rng(3)
    pieces = ["▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "aa"]
    chances = rng.random((len(pieces), 1)) / 4
    place = {p: k for k, p in enumerate(pieces)}

    def segmentations(word):
        if not word:
            yield 1.0, []
        for k in range(1, len(word) + 1):
            number = place.get(word[:k])
            own = [(chances[number, 0], [number])] if number is not None else []
            if k == 1:
                own.append((li.UNKNOWN, []))
            for p, used in own:
                for q, rest in segmentations(word[k:]):
                    yield p * q, used + rest

    words, weights = ["▁abc", "▁aab", "▁xab", "▁"], np.array([1.0, 2.5, 3.0, 1.0])
    want = np.zeros(len(pieces))
    for word, weight in zip(words, weights):
        found = list(segmentations(word))
        total = sum(p for p, _ in found)
        for p, used in found:
            for number in used:
                want[number] += weight * p / total
    assert np.allclose(li.expected_uses(words, weights, li.Lattice(pieces), chances), want)


def test_texts_in_no_learned_language_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = li.train(docs)
    odd = ["xqzv kjwq zzxv qpqp wvxk jjqz", "Hyvää huomenta kaikille ystäville", "こんにちは世界", "dgfhjk sdfgh " * 400, "Kuantum mekaniği parçacıkların davranışını açıklar"]
    clean = ["no", "A.", "la casa", "the the"]
    rows = [(-1 - k, t, None) for k, t in enumerate(odd)] + [(-100 - k, t, None) for k, t in enumerate(clean)]
    kept = {r["doc_id"] for r in li.keep_known_languages(docs.unionByName(spark.createDataFrame(rows, docs.schema)), model).collect()}
    lettered = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert kept == lettered | {-100 - k for k in range(len(clean))}


def test_thousands_of_languages(spark):
    """More languages than fit one block; each has a word of its own."""
    letters = "bcdfghjklmnpqrstvwxz"
    name = lambda k: "".join(letters[k // 20**j % 20] for j in range(3))
    rows = [(3 * k + j, f"{name(k)}a {name(k)}o {name(k)}a", f"x{k:04d}") for k in range(3500) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS n", "'w' AS word", "2 AS rank")
    model = li.train(docs)
    known = set(model.languages)
    assert len(known) > 3000 and len(model.blocks) == -(-len(known) // li.BLOCK_LANGUAGES)
    some = docs.filter("doc_id % 333 = 0")
    got = li.identify(some, model).collect()
    assert got and np.mean([r["lang_pred"] == r["lang"] for r in got if r["lang"] in known]) > 0.9
    assert li.keep_known_languages(some, model).columns == docs.columns


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" ▁\n\tab"), max_size=40), max_size=6))
def test_pieces_round_trip(texts):
    vocab, at = vocabulary(), 0
    ids, ends = sp.encode_texts(texts, vocab)
    for text, end in zip(texts, ends):
        assert sp.decode_ids(ids[at:end].tolist(), sp.piece_bytes(vocab)) == text
        at = end


def test_viterbi_against_all_segmentations():
    vocab, rng = vocabulary(), random.Random(4)
    words = sorted({MARK + "".join(rng.choices("theandörß漢\x01", k=rng.randint(1, 8))) for _ in range(300)})

    def best(word):
        if not word:
            return 0.0
        options = [vocab.scores[word[:k]] + best(word[k:]) for k in range(1, min(len(word), vocab.longest) + 1) if word[:k] in vocab.scores]
        return max([sp.BYTE_COST + best(word[1:]), *options])

    for word, path in zip(words, sp.encode_words(words, vocab)):
        inside = sum(vocab.scores[vocab.pieces[i]] for i in path if vocab.pieces[i] in vocab.scores)
        spelled = sum(c not in vocab.scores for c in word)
        assert math.isclose(inside + spelled * sp.BYTE_COST, best(word))


def test_pieces_frame(spark):
    import sentencepiece

    texts = [(1, None), (2, ""), (3, "Hello  world"), (4, "x" * 20000), (4, " ▁ "), (None, "\n")]
    got = sp.encoding_report(spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'c' AS decoded", "1 AS piece_ids")).collect()
    assert [r["exact"] for r in got] == [None, True, True, True, True, True] and got[0]["piece_ids"] is None and got[1]["piece_ids"] == []
    model = sentencepiece.SentencePieceProcessor(model_file=sp.VOCABULARY)
    assert model.decode(got[2]["piece_ids"]) == "Hello  world"


# Neighbours

def test_neighbours_edge_cases(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [None, 1.0]),
            (9, [1.0, 2.0, 3.0]), (10, []), (None, [1.0, 0.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id long, embedding array<double>, bucket int, vector string")
    got = defaultdict(list)
    for r in nn.nearest(df, df, k=5).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], round(r["score"], 9)))
    assert sorted(got) == [1, 2, 3, 4]
    assert sorted(got[1]) == [(1, 2, 1.0), (2, 3, 1.0), (3, 4, 0.0)]
    assert sorted(got[4]) == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0)]
    assert nn.nearest(df.filter("false"), df, k=5).count() == 0


def test_neighbours_in_blocks(spark, monkeypatch):
    """Hot buckets dealt out in a grid give the same as one block."""
    rng = np.random.default_rng(3)
    vectors = [(k, (np.ones(8) + 0.05 * rng.standard_normal(8)).tolist()) for k in range(3000)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    monkeypatch.setattr(nn, "BLOCK", 100)
    monkeypatch.setattr(nn, "LEAST_HOT", 100)
    points = np.array([v for _, v in vectors])
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    found = defaultdict(set)
    for r in nn.nearest(df, df.filter("vec_id % 100 = 0"), k=5).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = 0
    for query, names in found.items():
        scores = unit @ unit[query]
        scores[query] = -2
        hits += len(names & set(np.argsort(-scores)[:5].tolist()))
    assert len(found) == 30 and all(len(n) == 5 for n in found.values()) and hits >= 0.9 * 150


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("hashing", [{}, {"tables": 1, "width": 0.001, "probes": 1}])
def test_neighbours_with_repeated_ids(spark, same, hashing):
    """A nearest id with more than k rows, equal or not, takes one place; cells too small for k send all to the exact pass."""
    rng = np.random.default_rng(5)
    near = lambda noise: np.ones(8) + noise * rng.standard_normal(8)
    twin = near(0.001)
    rows = [(0, np.ones(8))] + [(1, twin if same else near(0.001)) for _ in range(12)]
    rows += [(k, near(0.01 * k)) for k in range(2, 6)] + [(k, rng.standard_normal(8)) for k in range(6, 300)]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in rows], "vec_id long, embedding array<double>")
    scores = defaultdict(lambda: -2.0)
    for k, v in rows[1:]:
        scores[k] = max(scores[k], v.sum() / np.linalg.norm(v) / math.sqrt(8))
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in nn.nearest(df, df.filter("vec_id = 0"), k=5, **hashing).collect())
    best = sorted(scores, key=lambda n: -scores[n])[:5]
    assert [(r, n) for r, n, _ in got] == list(enumerate(best, 1)) and np.allclose([s for *_, s in got], [scores[n] for n in best])


# Main text

def test_field_on_other_pages():
    field, wrong, total = mt.train(), 0, 0
    for blocks, labels in mt.labelled_pages(150, seed=77):
        wrong += sum(a != b for a, b in zip(field.decode(blocks), labels))
        total += len(labels)
    assert wrong / total < 0.01


def test_viterbi_is_the_best_labelling():
    field = mt.train()
    for blocks, _ in itertools.islice(mt.labelled_pages(40, seed=5), 40):
        blocks = blocks[:7]
        scores = [sum(field.weights.get(f, 0.0) for f in fs) for fs in mt.features(blocks)]

        def value(labels):
            steps = sum(field.steps[a][b] for a, b in zip(labels, labels[1:]))
            return steps + sum(s for s, x in zip(scores, labels) if x) + field.first * labels[0]

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=value)
        assert math.isclose(value(tuple(field.decode(blocks))), value(best), abs_tol=1e-9)


def test_broken_markup():
    texts = lambda page: [b.text for b in leaf_blocks(page)]
    assert texts("<p>a<p>b &amp; c<br>d  e<li>f") == ["a", "b & c d e", "f"]
    assert texts('<script>var x="</p>"</script>x<!-- <p>no --> y<style>p{}') == ["x y"]
    assert texts("a < b <p title='x>y'>c") == ["a < b", "c"] and texts("<p") == ["<p"] and texts("") == []
    assert texts("<div><script>never closed <p>x") == []


def test_attributes_of_other_pages_are_no_labels():
    for page in ('<div data-main="true"><p>x y</div>', '<div data-main=""><p>x y', '<article data-main="app"><p>x y</article>', "<p data-main=0>x y"):
        assert [b.text for b in leaf_blocks(page)] == ["x y"] and all(b.element.label == 0 for b in leaf_blocks(page))


def test_code_formulas_and_fallbacks_are_text():
    page = "<article><p>One line.</p><xmp>if (a < b) &amp; <p>c</xmp><p>Two <math><mi>x</mi></math> and <object>what <b>falls</b></object> <noscript>back</noscript>.</p></article>"
    want = ["One line.", "if (a < b) &amp; <p>c", "Two x and what falls back."]
    assert [b.text for b in leaf_blocks(page)] == want and mt.main_text(page, mt.train()) == "\n".join(want)


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a '" * 250_001, '<a ">"' * 150_000 + "'", "<div>x" * 100_000, "".join(f'<div class="c{k}">x' for k in range(50_000)),
    "<blockquote>" * 30_000 + "<li></li>" * 30_000 + "</section>" * 30_000, "<li><div>" + "<blockquote>" * 30_000 + "<li></li>" * 30_000, "<!-- " * 200_000,
], ids=["open tags", "open quotes", "quoted ends", "deep", "deep classes", "ends of nothing", "items in quotes", "comments"])
def test_broken_pages_take_linear_time(page):
    start = time.process_time()
    mt.main_text(page, mt.train())
    assert time.process_time() - start < 20


def test_main_text_on_an_empty_table(spark):
    assert mt.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_main_text_frame(spark):
    page = "<nav><a href=x>menu</a></nav><article><h1>T</h1><p>One &lt;two&gt;.</p><div class=ad>Buy now.</div><p>Three.</article><footer>f</footer>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<p>" * 3000)]
    got = mt.extract(spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert [r["text"] for r in got] == ["T\nOne <two>.\nThree."] * 2 + ["", "", ""] and got[0]["n_chars"] == 19


# Secrets

def test_spans():
    kinds = lambda t: [(ss.KINDS[k], a, b) for k, a, b, _ in ss.find_spans(t)]
    assert kinds("é PASSWORD = 'abcdef'") == [("assign", 2, 20)]
    assert kinds("secret=token: abcdefgh") == []  # the failed match covers the second word
    assert kinds("ſecret=abcdefgh toKen=abcdefg") == [("assign", 16, 29)]  # only ASCII letters fold
    assert kinds("AKIA" + "A1" * 8) == [("access", 0, 20)] and kinds("AKIA123") == []
    assert kinds("f" * 23) == [] and kinds("x" + "0a" * 12) == [("hex", 1, 25)]
    assert kinds(None) == [] and kinds("") == []


def test_ownership_and_masks(spark):
    live, shared = "token=" + "ab12" * 10, "token=" + "cd34" * 10
    rows = [(k, f"x {shared} y", f"s{k}") for k in range(5)] + [(9, f"x {live} y {live}", "s1"), (10, f"é{live}", "s1"), (11, None, None), (12, "", "s"), (None, live, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS live", "'k' AS text_key", "0 AS spans")
    got = {r["doc_id"]: r for r in ss.secret_report(docs).collect()}
    assert len(got) == len(rows) and got[0]["n_shared"] == 2 and got[0]["n_live"] == 0 and got[9]["n_live"] == 4
    out = ss.redact_live(docs)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == docs.columns and texts[9] == "x [SECRET] y [SECRET]" and texts[10] == "é[SECRET]" and texts[None] == "[SECRET]"
    assert texts[0] == rows[0][1] and texts[11] is None and texts[12] == ""
    assert ss.secret_report(docs.filter("false")).count() == 0


def pem(rng, kind="RSA ", end=True, gap="\n"):
    body = ["".join(rng.choices("ABCDEFxyz0189+/", k=n)) for n in (64, 64, 64, 23)]
    lines = [f"-----BEGIN {kind}PRIVATE KEY-----", *body[:3], body[3] + "=", f"-----END {kind}PRIVATE KEY-----"]
    return gap.join(lines if end else lines[:-1])


def test_key_spans():
    rng = random.Random(6)
    spans = lambda t: [(a, b) for k, a, b, _ in ss.find_spans(t) if ss.KINDS[k] == "key"]
    for gap in ("\n", "\r\n", "\\n", " ", '\\n" +\n  "', "\n> "):
        whole, cut = pem(rng, gap=gap), pem(rng, end=False, gap=gap)
        assert spans(f"é {whole} is a key.") == [(2, 2 + len(whole))]
        assert spans(f"{cut}\nNo end here, as you see.") == [(0, len(cut))]
        assert spans(f"{cut}\n{whole}") == [(0, len(cut)), (len(cut) + 1, len(cut) + 1 + len(whole))]
    sealed = pem(rng).replace("KEY-----\n", "KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n", 1)
    assert spans(sealed) == [(0, len(sealed))] and spans(sealed[:200]) == [(0, 200)]
    short = pem(rng, end=False)[: 31 + 1 + 64 + 1 + 9]
    assert spans(short) == [(0, len(short))] and spans(short + "\nThe rest is prose.") == [(0, len(short))]
    assert spans(short.replace("\n", "\n> ")) == [(0, len(short) + 4)]
    padded = pem(rng, end=False)
    assert spans(f"{padded}\nwords\n") == spans(f"{padded}\nsupercalifragilistic\n") == [(0, len(padded))]
    header = "-----BEGIN PRIVATE KEY-----"
    assert spans(f"A key starts with {header} and goes on.") == [(18, 18 + len(header))]
    assert spans("-----END PRIVATE KEY-----") == []
    for prose in (" marks the start, and after some prose of its own comes ", "\n" + "plain words between both lines " * 20 + "\n", " x. "):
        assert spans(f"{header}{prose}-----END PRIVATE KEY-----") == [(0, len(header))]
        assert spans(f"{cut}\n\n{prose}-----END RSA PRIVATE KEY-----") == [(0, len(cut))]


def test_keys_of_several_owners(spark):
    """Five owners have keys of one type: the key of two of them is live, that of three is copied."""
    rng = random.Random(7)
    live, shared = pem(rng), pem(rng)
    rows = [(k, f"x {live if k < 2 else shared} y", f"s{k}") for k in range(5)]
    # The same key in a string of a program counts as the same value.
    rows.append((5, "k = '" + shared.replace("\n", "\\n") + "'", "s4"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["n_live"], r["n_shared"]) for r in ss.secret_report(docs).collect()}
    assert got == {0: (1, 0), 1: (1, 0)} | {k: (0, 1) for k in range(2, 6)}
    texts = {r["doc_id"]: r["text"] for r in ss.redact_live(docs).collect()}
    assert texts == {k: "x [SECRET] y" if k < 2 else t for k, t, _ in rows}


# Quality

def test_votes_recover_accuracies():
    rng, count = np.random.default_rng(0), len(wq.LABELLERS)
    truth = rng.random(20000) < 0.8
    rates = np.linspace(0.7, 0.95, count)
    votes = np.where(rng.random((20000, count)) < rates, truth[:, None], ~truth[:, None]) * 2
    votes[rng.random(votes.shape) < 0.2] = wq.ABSTAIN
    numbers, counts = np.unique((votes * 3 ** np.arange(count)[::-1]).sum(axis=1), return_counts=True)
    model = wq.fit_votes(dict(zip(numbers.tolist(), counts.tolist())))
    assert abs(model.prior - 0.8) < 0.02 and np.allclose(list(model.accuracies().values()), rates, atol=0.02)


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (None, "the house and the tree are in the garden. " * 4)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in wq.score(docs, wq.train(docs)).collect()}
    assert len(rows) == 4 and rows[1]["score"] == rows[2]["score"] == rows[3]["score"] == 0 and not rows[1]["keep"] and 0 <= rows[None]["score"] <= 1
    assert wq.score(docs.filter("false"), wq.train(docs.filter("false"))).count() == 0


def test_quality_sample_is_bounded(spark):
    """Neither null texts, nor a hot text, nor a repeated row fill the sample or pass its bound."""
    docs = spark.range(12000).selectExpr("id AS doc_id", "CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'hot text' WHEN 2 THEN ' \\n' ELSE 'text ' || id END AS text")
    docs = docs.unionByName(spark.range(5000).selectExpr("7 AS doc_id", "'again' AS text"))
    rows = [r["text"] for r in wq.sample(docs, 500).collect()]
    assert len(rows) == 500 and all(r and r.strip() for r in rows) and rows.count("again") <= 1
    assert 150 < rows.count("hot text") < 350
    assert sorted(rows) == sorted(r["text"] for r in wq.sample(docs.repartition(7), 500).collect())
    assert len(wq.sample(docs, 100_000).collect()) == 6001 and wq.sample(docs.filter("false"), 500).count() == 0
    features = wq.sample_features(docs, wq.fit_votes(wq.pattern_counts(docs)), 500)
    assert features.count() == 500


def test_distinct_vote_does_not_depend_on_length():
    import pyarrow as pa

    rng = random.Random(8)
    varied = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    lengths = (500, 1999, 2000, 2001, 2500, 4001, 20_000)
    junk = [" ".join(f"w{k % 300}" for k in range(n)) for n in lengths[1:]]
    texts = junk + [varied(n) for n in lengths]
    votes = wq.LABELLERS["distinct"](wq.measures(*wq.byte_texts(pa.array(texts)))).tolist()
    assert votes == [wq.BAD] * len(junk) + [wq.GOOD] * len(lengths)


@pytest.mark.parametrize("text", ["", "a", "é" * 3])
def test_measures_are_finite(text):
    import pyarrow as pa

    found = wq.measures(*wq.byte_texts(pa.array([text, "the b"])))
    assert all(np.isfinite(v).all() and len(v) == 2 for v in found.values())
