"""Whitening and spectrum slicing against numpy's eigenvalues."""

import os

import numpy as np
import pytest

from quarry.llm import embedding_whitening as ew
from quarry.llm.catalog import llm_queries
from quarry.llm.spectrum import Factors, Slices, leading_eigenpairs

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RNG = np.random.default_rng(2)
TURN = np.linalg.qr(RNG.normal(size=(30, 30)))[0]
MATRICES = {
    "samples": np.cov(RNG.normal(size=(40, 300))),
    "identity": np.eye(6),
    "repeated": TURN @ np.diag([5.0] * 4 + [2.0] * 10 + [1.0] * 16) @ TURN.T,
    "steep": TURN @ np.diag(4.0 ** -np.arange(30)) @ TURN.T,
    "close": TURN @ np.diag(1 + 1e-9 * np.arange(30)) @ TURN.T,
    "rank five": np.cov(RNG.normal(size=(12, 6))),
    "ones": np.ones((5, 5)),
    "single": np.array([[3.0]]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_eigenpairs(name):
    matrix = (MATRICES[name] + MATRICES[name].T) / 2
    values, vectors = leading_eigenpairs(matrix, 32)
    want = np.linalg.eigvalsh(matrix)[::-1]
    assert len(values) == min(32, int((want > 1e-13 * len(matrix) * want[0]).sum())) or name == "steep"
    assert np.abs(values - want[: len(values)]).max() < 1e-13 * want[0]
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-12 * want[0]


def test_no_eigenpairs():
    assert len(leading_eigenpairs(np.zeros((4, 4)), 3)[0]) == 0 and len(leading_eigenpairs(np.zeros((0, 0)), 3)[0]) == 0


def test_factors_count_and_solve():
    matrix = RNG.normal(size=(25, 25))
    matrix = matrix + matrix.T
    values = np.linalg.eigvalsh(matrix)
    for shift in [-20.0, 0.0, 0.3, 20.0, float(values[3] + 1e-7), float(values[3] - 1e-7)]:
        factors = Factors(matrix, shift, Slices(matrix).scale)
        assert factors.above == (values > shift).sum()
        b = RNG.normal(size=25)
        assert np.allclose((matrix - shift * np.eye(25)) @ factors.solve(b), b, atol=1e-5)


def plain_whitening(rows, most=32):
    """{(id, component): |whitened|}, deviations, shares."""
    x = np.floor(64 * np.array([v for _, v in rows])) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(most, int((values > 1e-12 * max(values[0], 1e-300)).sum()))
    white = centred @ vectors[:, :count] / np.sqrt(values[:count])
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, total)) for row in x]
    return white, deviation, values[:count] / values.sum()


def compare(got, rows):
    white, deviation, shares = plain_whitening(rows)
    at = {key: k for k, (key, _) in enumerate(rows)}
    assert len(got) == white.size
    signs = {}
    for r in got:
        row, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == len(rows) and r["deviation"] == deviation[row] and r["explained"] == pytest.approx(shares[c], rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(abs(white[row, c]), abs=1e-7) and r["identity_error"] < 1e-9
        if abs(white[row, c]) > 1e-3:
            signs.setdefault(c, set()).add(r["whitened"] * white[row, c] > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_query_against_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    rows = [(k, v) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    compare(llm_queries()["op12_embedding_whitening"].run(spark, FOLDER).collect(), rows)


def test_rows_that_take_no_part(spark):
    good = [(k, [float(x) for x in v]) for k, v in enumerate(RNG.normal(size=(40, 5)) * 3)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [1.0, float("nan"), 0.0, 0.0, 0.0])]
    bad += [(104, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS whitened", "1 AS deviation", "2 AS row", "3 AS part")
    compare(ew.whitening_report(table).collect(), good)
    kept = ew.whiten(table, ew.fit(table))
    assert kept.columns == ["vec_id", "embedding", "row", "part", "deviation", "whitened"] and kept.count() == 40


def test_repeated_rows_and_small_tables(spark):
    table = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 5.0]), (4, [0.0, -1.0])]
    got = ew.whitening_report(table(rows)).collect()
    assert len(got) == 8 and {r["n"] for r in got} == {4} and sum(r["vec_id"] is None for r in got) == 2
    line = ew.whitening_report(table([(1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [3.0, 3.0])])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 3
    assert ew.whitening_report(table([(1, [1.0, 2.0])])).count() == 0
    assert ew.whitening_report(table([(1, [1.0]), (2, [1.0])])).count() == 0
    assert ew.whitening_report(table([])).count() == 0
    assert ew.whitening_report(table([(1, None)])).count() == 0


def test_large_deviations_are_exact_or_null(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [0.0, 3.0]), (3, [1.5, 2.0**21])]
    got = {r["vec_id"]: r["deviation"] for r in ew.whitening_report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    _, want, _ = plain_whitening(rows)
    assert got == {k: d if d < 1 << 63 else None for k, d in zip((1, 2, 3), want)}
