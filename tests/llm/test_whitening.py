import math
import random
from fractions import Fraction

import numpy as np
import pytest

from pledgeline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, d string, n int"


def table(spark, vectors):
    rows = [(k if k % 7 else None, v, 0, "x", "d", 1) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def usable(vectors):
    return [
        (k if k % 7 else None, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
        for k, v in enumerate(vectors)
        if v and all(c is not None and math.isfinite(c) and abs(c) < 1 << 40 for c in v)
    ]


def check(got, rows):
    """All columns against exact sums and another eigenvalue method."""
    fit = sorted({tuple(x) for _, x in rows})
    n, d = len(fit), len(fit[0])
    sums = [sum(column) for column in zip(*fit)]
    centred = [[x - Fraction(s, n) for x, s in zip(v, sums)] for v in fit]
    z = np.array(centred, float)
    covariance = z.T @ z / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = min(16, int((values > 1e-12 * values[0]).sum()))
    key = lambda r: repr((r[0], r[1:]))
    deviation = lambda x: sum((n * a - s) ** 2 for a, s in zip(x, sums))
    fits = lambda v: v if v < 1 << 63 else None
    expect = sorted(
        ((i, c, n, fits(deviation(x))) for i, x in rows for c in range(1, rank + 1)), key=key
    )
    assert sorted(((r.vec_id, r.component, r.n, r.deviation) for r in got), key=key) == expect
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r.whitened
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(covariance), rel_tol=1e-9)
        assert r.identity_error < 1e-9
    ids = [i for i, _ in rows if i is not None]
    x = {i: v for i, v in rows}
    away = np.array([[float(a - Fraction(s, n)) for a, s in zip(x[i], sums)] for i in ids])
    white = np.array([[by_id[i][c] for c in range(1, rank + 1)] for i in ids])
    ours = white * np.sqrt(values[:rank])
    # the same up to one sign per component
    theirs = away @ vectors[:, :rank]
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.abs(ours - theirs * signs).max() < 1e-7 * max(1.0, np.abs(theirs).max())


def vectors(d, count, seed=1):
    draw = np.random.default_rng(seed)
    spread = draw.normal(size=(d, d)) * np.linspace(3, 0.05, d)
    return (draw.normal(size=(count, d)) @ spread + draw.normal(size=d)).tolist()


def test_against_exact_sums(spark):
    rows = vectors(20, 300)
    # copies of one vector, of which all but one must not count, and unusable vectors
    rows += [rows[3]] * 200
    bad = [None, [], [1.0] * 19 + [None], [math.nan] + [0.0] * 19, [math.inf] * 20, [1e30] * 20]
    random.Random(4).shuffle(rows)
    rows += bad
    got = whitening.whiten(table(spark, rows)).collect()
    check(got, usable(rows))


@pytest.mark.parametrize("case", ["few", "flat", "far"])
def test_rank_and_size(spark, case):
    rows = vectors(6, 50, seed=5)
    if case == "few":
        rows = rows[:4]  # rank 3
    if case == "flat":
        rows = [[*r[:4], r[0], 7.0] for r in rows]  # a repeated and a constant dimension
    if case == "far":
        rows = [[1e9 * v for v in r] for r in rows]  # deviations that fit no long
    check(whitening.whiten(table(spark, rows)).collect(), usable(rows))


def test_equal_vectors_lengths_and_empty(spark):
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).columns == [c.split()[0] for c in whitening.WHITENED.split(",")]
    assert whitening.whiten(empty).count() == 0
    short, long = vectors(2, 30, seed=7), vectors(3, 30, seed=8)
    mixed = [v for pair in zip(short, long) for v in pair]
    got = whitening.whiten(table(spark, mixed)).collect()
    of = {i: len(x) for i, x in usable(mixed) if i is not None}
    for d in (2, 3):
        rows = [(i, x) for i, x in usable(mixed) if len(x) == d and i is not None]
        assert {r.vec_id for r in got if of.get(r.vec_id) == d} == {i for i, _ in rows}
        assert max(r.component for r in got if of.get(r.vec_id) == d) == d


def test_factor_and_rotation():
    draw = np.random.default_rng(3)
    for d, rank in ((1, 1), (5, 5), (8, 3), (33, 33)):
        a = draw.normal(size=(d, rank)) * 10.0 ** -np.arange(rank).clip(0, 6)
        scatter = a @ a.T
        factor = whitening.pivoted_cholesky(scatter)
        assert np.allclose(factor @ factor.T, scatter, atol=1e-13 * np.trace(scatter))
        values, components = whitening.eigen(scatter, 1)
        assert np.allclose(values, np.linalg.svd(a, compute_uv=False)[: len(values)] ** 2, rtol=1e-6)
        assert np.allclose(components @ components.T, np.eye(len(values)), atol=1e-13)
    assert whitening.eigen(np.zeros((4, 4)), 3)[0].size == 0
