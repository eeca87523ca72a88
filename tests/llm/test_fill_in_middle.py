"""Fill-in-middle: skip list, cuts and their way back against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import fill_in_middle as fim


def plain_cut(key, text):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if h4 % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 300, 5000])
def test_skip_list_places(size):
    widths = np.random.default_rng(size).integers(1, 90, size)
    lines, before = fim.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
    assert [lines.place(k) for k in range(size + 1)] == before.tolist()
    for units, points, _ in lines.lanes:
        assert units.sum() == size and points.sum() == widths.sum()
    with pytest.raises(IndexError):
        lines.place(size + 1)


def test_cuts_against_plain_python(spark):
    rng = random.Random(5)
    texts = [None, "", "\n", "\n\n\n", "one", "one\n", "a\r\nb\rc", "with <P> in it\nx", "<S", "<\n<P\n<", "é\n💾漢\n" * 30, "x" * 100_000, "long line\n" * 200_000]
    texts += ["".join(rng.choice("ab<PSM>\n\té漢") for _ in range(rng.randrange(80))) for _ in range(200)]
    rows = list(enumerate(texts)) + [(None, "a\nb\nc"), (12, texts[12]), (-4, "a\nb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fim.fill_in_middle(docs).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_cut(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {"plain", "psm", "spm"} == {r["form"] for r in got}


def test_rates_and_clashing_columns(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('a\\nb\\nc', id) AS text", "1 AS N", "'x' AS output", "2 AS _h0", "3 AS other")
    got = fim.fill_in_middle(docs, seed=3, percent=30, spm_percent=0).collect()
    plain = sum(r["form"] == "plain" for r in got)
    assert 230 < plain < 330 and {r["form"] for r in got} == {"plain", "psm"}
    assert all(r["n"] == 3 and r["other"] == 3 and r["_h0"] == 2 for r in got)
    assert fim.fill_in_middle(docs.filter("false")).count() == 0
    assert fim.fill_report(docs.filter("false")).columns[0] == "doc_id"
