"""Queries of the llm folder on a given table: equal to their SQL twins, or to plain Python versions."""

import hashlib
import os
import re
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm.catalog import llm_queries
from tests.oracle import difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = llm_queries()


def rows_of(spark, name, folder=FOLDER):
    return QUERIES[name].run(spark, folder).collect()


def documents(spark, folder=FOLDER):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_groups(texts, percent, size=5):
    """{id: (set size, smallest reachable id)} by comparing all pairs that share a shingle."""
    sets = {}
    for key, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[key] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent, shared, holders = {k: k for k in sets}, defaultdict(int), defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for key in sorted(sets):
        for shingle in sets[key]:
            for other in holders[shingle]:
                shared[other, key] += 1
            holders[shingle].append(key)
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_equals_sql(spark, name):
    assert difference(spark, FOLDER, QUERIES[name]) is None


def test_near_duplicates(spark):
    want = plain_groups({k: r["text"] for k, r in documents(spark).items()}, 85)
    got = rows_of(spark, "op5_near_duplicates")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_language_id(spark):
    docs, got = documents(spark), rows_of(spark, "op6_language_id")
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert held and np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97


def test_sentence_pieces(spark):
    got = rows_of(spark, "op7_sentence_pieces")
    assert len(got) == len(documents(spark)) and all(r["exact"] and len(r["piece_ids"]) == r["n_pieces"] for r in got)


def test_neighbours(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in rows_of(spark, "op8_neighbours"):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    found = 0
    for query in ids[ids % 50 == 0]:
        scores = unit @ unit[ids == query][0]
        scores[ids == query] = -2
        best = ids[np.lexsort((ids, -scores))[:5]]
        ranks, names, values = zip(*sorted(got[query]))
        assert ranks == (1, 2, 3, 4, 5) and list(values) == sorted(values, reverse=True)
        assert np.allclose(values, [scores[ids == n][0] for n in names], atol=1e-12)
        found += len(set(best.tolist()) & set(names))
    assert found / (5 * len(got)) >= 0.9


def test_main_text(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in rows_of(spark, "op9_main_text"):
        page = pages[r["page_id"]]
        inner = re.sub(r"<br>|</?b>", " ", page[page.index("<article>") + 9 : page.index("</article>")])
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])


def test_secret_scan(spark):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    folder = "/root/testdata/sf0.01"  # the smallest table has no secrets
    docs, order, seen = documents(spark, folder), ["assign", "access", "hex"], 0
    for r in rows_of(spark, "op10_secret_scan", folder):
        text = docs[r["doc_id"]]["text"] or ""
        spans = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        spans.sort(key=lambda s: (s[1], order.index(s[0])))
        plain = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in spans) for k in order)
        seen += len(spans)
    assert seen


def test_weak_quality(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = QUERIES["op3_weak_quality"].run(spark, "/root/testdata/sf0.01").collect()
    keep = {v: np.mean([r["keep"] for r in got if labels.get(r["doc_id"]) == v]) for v in (0, 1)}
    assert len(got) == 1000 and keep[1] > 0.95 and keep[0] < 0.15


def test_pipeline(spark):
    """Kept ids by plain Python; texts differ only where a secret is masked; encoding is exact."""
    docs = documents(spark)
    lettered = {k: r["text"] for k, r in docs.items() if any(c.isalpha() for c in r["text"] or "")}
    groups = plain_groups(lettered, 80)
    alone = {k: lettered[k] for k, (_, first) in groups.items() if k == first}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(r["text"])
        size = min(13, len(w))
        if w:
            windows[size] |= {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}

    def clean(text):
        w, hit = words(text), set()
        for size, known in windows.items():
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in known:
                    hit.update(range(k, k + size))
        return not (hit and 20 * len(hit) >= len(w))

    got = {r["doc_id"]: r for r in rows_of(spark, "pipeline")}
    assert set(got) == {k for k, t in alone.items() if clean(t)}
    for k, r in got.items():
        assert r["exact"] and r["n_pieces"] == len(r["piece_ids"]) and r["lang"] == docs[k]["lang"]
        assert r["text"] == docs[k]["text"] or "[SECRET]" in r["text"]
