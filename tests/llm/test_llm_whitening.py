"""Whitening against exact arithmetic and a library's eigenvectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from halfspace.llm import whitening

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def symmetric(values: list[float], seed: int = 0) -> np.ndarray:
    basis, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    matrix = basis @ np.diag(values) @ basis.T
    return (matrix + matrix.T) / 2


SPECTRA = {
    "spread": [*np.linspace(1, 40, 40)],
    "close": [5 + 1e-6 * i for i in range(12)] + [1.0] * 20,
    "falling": [10.0**-i for i in range(14)],
    "one": [3.0],
    "two": [3.0, 3.0],
    "equal": [7.0] * 24,
    "pairs": [9, 9, 8, 8, 7, 7, 6, 6, 5, 5, 4, 4, 1, 1],
    "low rank": [4, 3, 2] + [0.0] * 30,
    "tie at the cut": [9, 8, 7, 6, 5, 4, 3, 2, 2, 2, 1, 1],
    "huge": [1e300, 2e299, 1e299],
    "tiny": [1e-290, 2e-291],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_components_are_the_leading_eigenvectors(name):
    matrix = symmetric(SPECTRA[name])
    values, vectors = whitening.leading_components(matrix, 8)
    expected = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    wanted = min(8, int((expected > whitening.RANK * expected[0]).sum()))
    assert len(values) == wanted
    scale = expected[0]
    assert np.abs(values - expected[:wanted]).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() <= 1e-12
    residual = matrix / scale @ vectors - vectors * (values / scale)
    assert np.abs(residual).max() <= 1e-13


@pytest.mark.parametrize("seed", range(5))
def test_inertia_counts(seed):
    values = np.random.default_rng(seed).integers(-5, 6, 17).astype(float)
    inertia = whitening.Inertia(symmetric([*values], seed))
    for number in np.arange(-5.5, 6, 0.5):
        if number % 1:
            assert inertia.above(number) == (values > number).sum()


def test_intervals_hold_what_they_count():
    matrix = symmetric([*np.linspace(1, 40, 40)])
    found = whitening.intervals(whitening.Inertia(matrix), 20, most=3)
    assert len(found) > 5 and all(0 < count <= 3 for _, _, count in found)
    assert sum(count for _, _, count in found) >= 20
    for low, high, count in found:
        values, vectors = whitening.feast(matrix, low, high, count)
        assert len(values) == count and ((low < values) & (values < high)).all()


def test_a_missed_eigenvalue_is_noticed():
    with pytest.raises(whitening.MissedEigenvaluesError):
        whitening.feast(symmetric([1.0, 2.0, 3.0, 4.0]), 2.5, 4.5, 3)


def exact(rows: list[tuple]) -> dict:
    """Sums, deviations and covariance in fractions."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    n, size = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(size)]
    mean = [Fraction(s, n) for s in sums]
    covariance = [
        [float(sum((x[a] - mean[a]) * (x[b] - mean[b]) for _, x in kept) / n) for b in range(size)]
        for a in range(size)
    ]
    deviations = [(i, sum((n * x[d] - sums[d]) ** 2 for d in range(size))) for i, x in kept]
    white = [(i, [float(x[d] - mean[d]) for d in range(size)]) for i, x in kept]
    return {"n": n, "covariance": np.array(covariance), "deviations": deviations, "centred": white}


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(8)
    mixing = draw.standard_normal((10, 10))
    rows = [(i, (draw.standard_normal(10) @ mixing).tolist()) for i in range(150)]
    rows += [(None, rows[3][1]), (3, rows[3][1]), (3, rows[4][1]), (900, None), (901, [None] * 10)]
    return rows + [(902, [float("nan")] * 10), (903, [1.0] * 9 + [float("inf")]), (904, [0.0] * 10)]


def test_as_exact_arithmetic(spark, rows):
    done = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    want = exact(rows)
    assert done.n == want["n"]
    values = np.linalg.eigvalsh(want["covariance"])[::-1]
    assert np.allclose(done.values, values[:8], rtol=1e-12)
    assert np.allclose(done.explained, values[:8] / values.sum(), rtol=1e-10)
    got = sorted((str(r.vec_id), int(r.deviation), *r.white) for r in done.rows.collect())
    assert sorted((i, d) for i, d, *_ in got) == sorted((str(i), d) for i, d in want["deviations"])
    scaled = done.vectors / np.sqrt(done.values)
    white = sorted((str(i), *(np.array(x) @ scaled)) for i, x in want["centred"])
    first = [row[:1] + row[2:] for row in got]
    for ours, theirs in zip(sorted(first), white, strict=True):
        assert ours[0] == theirs[0] and np.allclose(ours[1:], theirs[1:], atol=1e-9)
    matrix = np.array([row[1:] for row in first])
    error = np.abs(np.cov(matrix.T, bias=True) - np.eye(8)).max()
    assert done.identity_error < 1e-10 and error < 1e-10


def test_large_numbers_stay_exact():
    """Beyond a long, deviations are whole numbers of any size."""
    draw = np.random.default_rng(2)
    numbers = draw.integers(-(2**40), 2**40, (30, 3))
    sums = [int(s) * 10**9 + 7 for s in numbers.sum(axis=0)]
    n = 30 * 10**9
    got = whitening.Center.of(n, sums).deviations(numbers)
    assert got == [sum((n * int(x) - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in numbers]


def test_odd_tables(spark):
    query = lambda rows: whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert query([]) is None
    assert query([(1, None), (2, []), (3, [None])]) is None
    assert query([(1, [0.5, 0.25]), (2, [0.5, 0.25])]) is None
    short = query([(1, [0.5, 0.25]), (2, [0.0, 1.0]), (3, [0.5]), (4, [])])
    assert short.n == 2 and len(short.values) == 1 and short.rows.count() == 2
    with pytest.raises(Exception, match="beyond a long"):
        query([(1, [3e38]), (2, [1.0])])
    wide = "vec_id INT, embedding ARRAY<DOUBLE>, white INT, deviation STRING, line INT, n INT"
    df = spark.createDataFrame([(1, [0.5, 1.0], 1, "d", 1, 1), (2, [2.0, 0.0], 1, "d", 1, 1)], wide)
    assert whitening.whiten(df).n == 2


def test_query(spark, sf_dir):
    df = whitening.op12_whitening(spark, sf_dir)
    assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == whitening.RESULT
    rows = df.collect()
    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    want = exact([(r.vec_id, r.embedding) for r in source])
    assert len(rows) == 8 * want["n"] == 8 * len(source)
    assert {(r.vec_id, r.deviation) for r in rows} == set(want["deviations"])
    assert {r.n for r in rows} == {want["n"]} and rows[0].identity_error <= 1e-4
    values = np.linalg.eigvalsh(want["covariance"])[::-1]
    shares = dict(enumerate(values[:8] / values.sum(), 1))
    assert all(math.isclose(r.explained, shares[r.component], rel_tol=1e-9) for r in rows)
