"""Whitening against numpy's own eigenvectors and exact fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest

from sessionrate.llm import whitening as W
from sessionrate.llm.common import read_table
from sessionrate.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    v = (q * np.array(values, dtype=float)) @ q.T
    return (v + v.T) / 2


SPECTRA = {"spread": [1.3 ** i for i in range(64)], "level": [50 + i / 100 for i in range(64)],
           "groups": [5.0] * 20 + [5.0 + 1e-7] * 20 + [9.0] * 24, "equal": [3.0] * 40, "low rank": [0.0] * 60 + [1, 2, 3],
           "one": [7.0], "two": [2.0, 1.0], "steep": [10.0 ** -i for i in range(30)], "zero": [0.0] * 4}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_components(name):
    v = spectrum(SPECTRA[name])
    values, vectors = W.leading(v)
    true = np.sort(np.linalg.eigvalsh(v))[::-1]
    scale = max(abs(true).max(), 1e-300)
    want = [x for x in true[:W.COMPONENTS] if x > 1e-13 * scale] if true.max() > 1e-200 else []
    if name == "steep":                                        # the last ones are at rounding level
        assert 13 <= len(values) <= 17
        want = want[:len(values)]
        values, vectors = values[:len(want)], vectors[:, :len(want)]
    assert len(values) == len(want)
    if len(want):
        assert np.abs(values - want).max() < 1e-13 * scale * len(v)
        assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12
        assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-12 * scale


def test_inertia_counts():
    v = spectrum(range(1, 30))
    cuts = np.arange(0, 31) + 0.5
    assert W.below(*W.tridiagonal(v), cuts).tolist() == [min(29, i) for i in range(31)]


def test_intervals_cover_the_wanted_values_once():
    diag, off = W.tridiagonal(spectrum(SPECTRA["spread"]))
    cuts = W.intervals(diag, off, 32)
    assert sum(n for _, _, n in cuts) >= 32 and all(n <= W.PER_INTERVAL for _, _, n in cuts)
    assert all(a[0] == b[1] for a, b in zip(cuts, cuts[1:]))


def test_a_missed_value_is_noticed():
    with pytest.raises(RuntimeError, match="not all of them were found"):
        W.feast(spectrum(range(1, 10)), 2.5, 5.5, 4)


def check(rows, got, k=W.COMPONENTS):
    """``rows``: (key, list) that are usable."""
    n, d = len(rows), len(rows[0][1])
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(r[i] for r in x) for i in range(d)]
    centred = np.array([[float(Fraction(n * r[i] - sums[i], n)) for i in range(d)] for r in x])
    v = centred.T @ centred / n
    true = np.linalg.eigvalsh(v)[::-1]
    m = min(k, int((true > 1e-12 * true[0]).sum()))
    assert len(got) == n * m and all(r.n == n for r in got)
    dev = {key: sum((n * a - s) ** 2 for a, s in zip(r, sums)) for (key, _), r in zip(rows, x)}
    assert all(r.deviation == dev[r.vec_id] for r in got)
    white = np.zeros((n, m))
    at = {key: i for i, (key, _) in enumerate(rows)}
    for r in got:
        white[at[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained - true[r.component - 1] / true.sum()) < 1e-9 * r.explained
    # projections on unit eigenvectors, whatever their signs
    vectors = np.linalg.lstsq(centred, white * np.sqrt(true[:m]), rcond=None)[0]
    assert np.abs(v @ vectors - vectors * true[:m]).max() < 1e-8 * true[0]
    assert np.abs(np.cov(white.T, bias=True).reshape(m, m) - np.eye(m)).max() < 1e-9
    assert {r.identity_error for r in got} and max(r.identity_error for r in got) < 1e-9


def test_query(spark):
    df = read_table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = QUERIES["op13_feast_whitening"](spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, got.collect())


def test_awkward_rows(spark, many_parts):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (104, [1.0, 2.0]), (105, []), (106, [1e300] * 5)]
    df = spark.createDataFrame([(k, v, "x", 1.0) for k, v in rows + bad],
                               "vec_id long, embedding array<double>, component string, deviation double").repartition(3)
    check(rows, W.whiten(df).collect())
    assert len(W.whiten(df, k=2).collect()) == 80


def test_repeated_rows_count_as_often(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [3.0, 2.0]), (None, [1.0, 5.0])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 8 and {r.n for r in got} == {4} and sum(r.vec_id is None for r in got) == 2


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0]), (2, [2.0])]])
def test_no_components_no_rows(spark, rows):
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert not out.collect()


def test_too_large_a_deviation_is_an_error(spark):
    rows = [(i, [float(1 << 39) * (i % 2)]) for i in range(40)]
    with pytest.raises(Exception, match="exceeds a long"):
        W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
