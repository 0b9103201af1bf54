"""Whitening against exact sums and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from turnloom.llm import whitening as X
from turnloom.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, component int, n string"


def random_rows(seed, n, size):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((size, size))
    return (rng.standard_normal((n, size)) @ mix).astype(np.float32).tolist()


def exact_covariance(xs):
    n, size = len(xs), len(xs[0])
    sums = [sum(x[k] for x in xs) for k in range(size)]
    d = [[n * x[k] - sums[k] for k in range(size)] for x in xs]
    return np.array(
        [[float(Fraction(sum(r[a] * r[b] for r in d), n**3)) for b in range(size)] for a in range(size)]
    ), sums


def check(df, rows, size, components=8):
    """Against integers of any size and numpy's double solver."""
    good = [(k, v) for k, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    xs = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in good]
    cov, sums = exact_covariance(xs)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    n = len(xs)
    got = df.collect()
    use = [k for k in range(min(components, size)) if values[k] > np.trace(cov) * size * 1e-13]
    assert len(got) == n * len(use)
    white = {k: {} for k in use}
    devs = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-8
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
        white[r["component"] - 1].setdefault(r["vec_id"], []).append(r["whitened"])
        devs.setdefault(r["vec_id"], set()).add((r["deviation"], r["deviation_text"]))
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(x, sums)] for x in xs])
    for (key, _), x in zip(good, xs):
        exact = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        assert (exact if exact < 1 << 63 else None, str(exact)) in devs[key]
    for c in use:
        want = centred @ vectors[:, c] / math.sqrt(values[c])
        for sign in (1, -1):
            if all(any(abs(w * sign - g) < 1e-6 for g in white[c][key]) for (key, _), w in zip(good, want)):
                break
        else:
            raise AssertionError(f"component {c + 1}")


def test_against_numpy(spark):
    rows = [(k, v) for k, v in enumerate(random_rows(1, 300, 12))]
    rows += [(300, None), (301, [None] * 12), (302, [float("nan")] + [0.0] * 11), (303, [math.inf] * 12), (304, [1.0]), (305, [])]
    rows += [(5, rows[5][1]), (None, rows[7][1])]
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], SCHEMA).repartition(4)
    check(X.whiten(df), rows, 12)
    check(X.whiten(df, components=3), rows, 12, 3)


def test_small_and_degenerate_tables(spark):
    make = lambda vs: spark.createDataFrame([(k, v, 1, "x") for k, v in enumerate(vs)], SCHEMA)
    assert X.whiten(make([])).collect() == []
    assert X.whiten(make([None, [math.nan]])).collect() == []
    assert X.whiten(make([[1.0, 2.0]])).collect() == []
    assert X.whiten(make([[1.0, 2.0]] * 5)).collect() == []
    line = [[float(k), 2.0 * k, 0.0] for k in range(9)]
    check(X.whiten(make(line)), list(enumerate(line)), 3)
    huge = [[3e11 * (-1) ** k * (k % 5), 1.0 * (k % 7)] for k in range(40)]
    got = X.whiten(make(huge)).collect()
    assert {r["deviation"] for r in got} >= {None} and all(int(r["deviation_text"]) >= 0 for r in got)


def spread(values, seed):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 40, 40),
        [1e6, 1e3, 1, 1e-2],
        [5.0, 5.0 + 1e-7, 5.0 - 1e-7, 3.0, 1.0],  # below the resolution of float32
        [2.0 + 1e-10 * k for k in range(6)] + [1.0, 0.5],
        [1.0] * 6 + [4.0],
    ],
)
def test_refinement_reaches_double_precision(values):
    a = spread(values, 3)
    a = (a + a.T) / 2
    e, x = X.refined(a)
    top = np.abs(a).max()
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-14
    assert np.abs(a @ x - x * e).max() < 1e-13 * max(top, abs(np.array(values)).max())
    assert e == pytest.approx(np.sort(values)[::-1], rel=1e-12, abs=1e-12 * top)
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    if len(set(np.round(values, 3))) == len(values):
        assert np.abs(rough.T @ a @ rough - np.diag(np.diag(rough.T @ a @ rough))).max() > 1e-9 * top


def test_clustered_eigenvectors_by_sub_solves():
    """Gaps of 1e-9 are invisible in float32; the vectors still come out right."""
    values = [3.0, 1.0 + 2e-9, 1.0 + 1e-9, 1.0, 0.2]
    q = np.linalg.qr(np.random.default_rng(5).standard_normal((5, 5)))[0]
    a = (q * np.array(values)) @ q.T
    _, x = X.refined((a + a.T) / 2)
    assert np.abs(np.abs(q.T @ x) - np.eye(5)).max() < 1e-5


def test_given_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    check(X.op11_refined_whitening(spark, sf_dir), rows, 64)
