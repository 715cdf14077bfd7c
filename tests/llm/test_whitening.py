"""Whitening against numpy's eigenvectors of the whole covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest

from rowtide.llm import whitening
from rowtide.llm.queries import op11_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, component int, rows string"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
CLASH = (1, "x", 2, 3, "r")


def by_hand(vectors: list[tuple]) -> dict:
    """(vec_id, vector) rows of one length -> the fit and each row's numbers."""
    x = [[math.floor(256 * float(np.float32(c))) for c in e] for _, e in vectors]
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, s = len(fit), fit.sum(0)
    centred = (fit - s / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    dev = [sum((n * c - t) ** 2 for c, t in zip(r, s, strict=True)) for r in x]
    return {"n": n, "x": np.array(x, float) - (s / n).astype(float), "values": values, "axes": axes, "dev": dev, "trace": values.sum()}


def check(got: list, vectors: list[tuple], k: int) -> None:
    hand = by_hand(vectors)
    assert len(got) == k * len(vectors)
    want = hand["x"] @ hand["axes"][:, :k] / np.sqrt(hand["values"][:k])
    by = {}
    for r in got:
        by.setdefault(r.component, {})[r.vec_id] = r
        assert r.n == hand["n"] and r.identity_error < 1e-9
    at = {vec_id: i for i, (vec_id, _) in enumerate(vectors)}
    for j in range(k):
        rows = by[j + 1]
        mine = np.array([rows[v].whitened for v in at])
        theirs = want[:, j]
        sign = np.sign(mine[np.abs(theirs).argmax()] * theirs[np.abs(theirs).argmax()])
        np.testing.assert_allclose(mine * sign, theirs, rtol=1e-6, atol=1e-9)
        for v, i in at.items():
            assert rows[v].deviation == hand["dev"][i]
            assert abs(rows[v].explained / (hand["values"][j] / hand["trace"]) - 1) < 1e-9


def test_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = op11_embedding_whitening(spark, sf)
    assert out.columns == COLUMNS
    check(out.collect(), rows, 4)


@pytest.mark.parametrize("spread", [[8, 4, 2, 1, 0.5, 0.25, 0.1], [1, 1, 1, 1, 1], [9, 3, 0, 0, 0]])
def test_spectra(spark, spread):
    drawn = np.random.default_rng(1)
    m = drawn.standard_normal((300, len(spread))) * spread
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(m)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # copies count once
    out = whitening.whiten(spark.createDataFrame([r + CLASH for r in rows], SCHEMA).repartition(5))
    assert out.columns == COLUMNS
    check(out.collect(), rows, sum(s > 0 for s in spread[:4]))


def test_equal_variances_leave_no_component_out(spark):
    """Unit vectors, both ways: every direction has the same variance, and the first v is done at once."""
    rows = [(2 * j + s, [(1.0 - 2 * s) * (j == i) for i in range(6)]) for j in range(6) for s in (0, 1)]
    got = whitening.whiten(spark.createDataFrame([r + CLASH for r in rows], SCHEMA)).collect()
    assert len(got) == 4 * 12
    assert all(abs(r.explained - 1 / 6) < 1e-12 and r.identity_error < 1e-12 for r in got)


def test_fewer_vectors_than_dimensions(spark):
    drawn = np.random.default_rng(2)
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(drawn.standard_normal((3, 20)))]
    check(whitening.whiten(spark.createDataFrame([r + CLASH for r in rows], SCHEMA)).collect(), rows, 2)


def test_what_takes_no_part(spark):
    good = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 0.9]), (None, [-1.0, -0.2]), (3, [0.1, 0.7])]
    bad = [(9, None), (9, []), (9, [1.0, None]), (9, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (9, [1.0]), (9, [1.0, 2.0, 3.0])]
    got = whitening.whiten(spark.createDataFrame([r + CLASH for r in good + bad], SCHEMA)).collect()
    assert sorted([r.vec_id for r in got], key=str) == sorted([i for i, _ in good for _ in range(2)], key=str)
    assert {r.n for r in got} == {5}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_no_components(spark, rows):
    out = whitening.whiten(spark.createDataFrame([r + CLASH for r in rows], SCHEMA))
    assert out.columns == COLUMNS and out.count() == 0


def test_far_numbers(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [3e15, 2.0]), (4, [0.0, 3.0])]
    got = whitening.whiten(spark.createDataFrame([r + CLASH for r in rows], SCHEMA)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 4}
    assert all(r.deviation is None for r in got if r.vec_id in (1, 2))


def test_deviations_beyond_numpy():
    rows = np.array([[1 << 40, 5], [3, 4]])
    assert whitening.deviations(rows[1:], 2, [3, 9]) == [9 + 1]
    assert whitening.deviations(np.array([[1 << 31, 0]]), 2, [0, 0]) == [None]
    assert whitening.deviations(np.array([[1 << 30, 0]]), 2, [0, 0]) == [1 << 62]


def test_steps_end_early_on_a_steep_spectrum(spark):
    drawn = np.random.default_rng(3)
    m = drawn.standard_normal((400, 40)) * (2.0 ** -np.arange(40) * 50)
    vectors = whitening.whole_vectors(spark.createDataFrame([(i, [float(v) for v in e], *CLASH) for i, e in enumerate(m)], SCHEMA))
    assert whitening.fit(vectors, 40).steps < 30


def test_sums_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FEW", 1)
    rows = [(i, [float(i % 7), float(i % 5), 1.0 / (i + 1)]) for i in range(60)]
    check(whitening.whiten(spark.createDataFrame([r + CLASH for r in rows], SCHEMA).repartition(5)).collect(), rows, 3)
