"""The metric-space join against all pairs in plain Python, with regions small enough to be split."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import jaccard_join as jj
from quarry.llm.catalog import llm_queries
from tests.llm.test_queries import FOLDER, documents, plain_groups


def compare(spark, texts, percent=80):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS row", "'s' AS shingle", "0 AS n", "2 AS component", "3 AS sample")
    got = jj.jaccard_components(docs, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_groups(texts, percent)


def test_query(spark):
    want = plain_groups({k: r["text"] for k, r in documents(spark).items()}, 80)
    got = llm_queries()["op13_jaccard_join"].run(spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def clusters(rng):
    """Near copies around bases that are not there, chains, and texts that share passages only."""
    texts = {}
    for c in range(3):
        base = [f"b{c}x{k}" for k in range(160)]
        for k in range(70):
            copy = list(base)
            for at in rng.sample(range(0, 160, 5), rng.choice((1, 1, 2, 3, 4))):
                copy[at] = f"e{rng.randrange(30)}"
            texts[1000 * c + k] = " ".join(copy)
    chain = [f"c{k}" for k in range(120)]
    for k in range(40):
        texts[5000 + k] = " ".join(chain[2 * k :] + [f"c{120 + j}" for j in range(2 * k)])
    passage = " ".join(f"p{k}" for k in range(90))
    for k in range(60):
        texts[6000 + k] = passage + " " + " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(4, 40)))
    return texts


@pytest.mark.parametrize("weight,pivots,levels", [(500_000, 16, 4), (4000, 4, 3), (3000, 2, 1), (2000, 16, 0)])
def test_regions_are_split_exactly(spark, monkeypatch, weight, pivots, levels):
    monkeypatch.setattr(jj, "LEAF_WEIGHT", weight)
    monkeypatch.setattr(jj, "PIVOTS", pivots)
    monkeypatch.setattr(jj, "LEVELS", levels)
    compare(spark, clusters(random.Random(weight)))


def test_edge_cases(spark):
    long = " ".join(f"v{k % 7000}" for k in range(60_000))
    texts = {1: None, 2: "", 3: " \t\n", 4: "one two", 5: "ONE\ntwo", 6: "two one", 7: "É é", 8: "é É", 9: long, 10: long.upper() + " end", 11: "a a a a a a a", 12: "a a a a a"}
    compare(spark, texts)
    compare(spark, texts, 100)
    compare(spark, {k: f"text {k} of its own with nothing shared {k}" for k in range(30)})
    assert jj.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_and_null_ids(spark):
    a, b, c = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [(1, a), (1, b), (2, b), (None, a), (None, c), (None, c), (None, None), (3, a)]
    got = jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((str(r["doc_id"]), str(r["component_id"]), r["n_shingles"]) for r in got)
    assert found == sorted([("1", "1", 3), ("1", "1", 3), ("2", "1", 3), ("None", "1", 3), ("None", "None", 3), ("None", "None", 3), ("None", "None", 0), ("3", "1", 3)])


def test_assignment_keeps_every_close_pair():
    """No two members within the radius are without a common Voronoi region."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 10**9, 400)
    sets = []
    for k in range(150):
        kept = base[(k % 5) * 60 : (k % 5) * 60 + 100].copy()
        change = rng.choice(100, rng.integers(0, 60), replace=False)
        kept[change] = rng.integers(0, 10**9, len(change))
        sets.append(np.unique(kept))
    table = lambda rows: pa.table({
        "region": ["r"] * len(rows), "set_id": pa.array(rows, pa.int64()), "n": pa.array([len(sets[k]) for k in rows], pa.int64()),
        "alone": pa.array([0] * len(rows), pa.int64()), "component": pa.array(rows, pa.int64()), "shingles": pa.array([sets[k] for k in rows], pa.list_(pa.int64())),
    })
    found = jj.assign_regions(table(list(range(150))), table(list(range(0, 150, 11))), 80, 0.2).to_pylist()
    regions = {}
    for r in found:
        regions.setdefault(r["set_id"], set()).add(r["pivot"])
    for x in range(150):
        for y in range(x):
            shared = len(np.intersect1d(sets[x], sets[y]))
            if 100 * shared >= 80 * (len(sets[x]) + len(sets[y]) - shared):
                assert regions[x] & regions[y]
    assert sum(len(v) for v in regions.values()) < 150 * 4
