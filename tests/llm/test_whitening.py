"""Leading components and whitened rows against a dense decomposition of the exact covariance."""

import math
import random

import numpy as np
import pytest

from match_lake.llm import whitening


def remaining(rows):
    return [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, whitened string").repartition(3)
    return [tuple(r) for r in whitening.whiten(df, **options).collect()]


def check(got, rows, k=32):
    """Against numpy on the whole matrix."""
    rows = remaining([(i, None if v is None else [None if c is None else np.float32(c) for c in v]) for i, v in rows])
    ints = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(ints), len(ints[0])
    sums = [sum(col) for col in zip(*ints)]
    c = np.array([[n * x - s for x, s in zip(row, sums)] for row in ints], float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(k, d, int((e > d * 1e-13 * e[0]).sum()))
    assert sorted({r[1] for r in got}) == list(range(1, k + 1)) and len(got) == n * k
    deviations = sorted((i is None, i or 0, sum((n * x - s) ** 2 for x, s in zip(row, sums))) for (i, _), row in zip(rows, ints))
    for m in range(1, k + 1):
        own = sorted((r for r in got if r[1] == m), key=lambda r: (r[0] is None, r[0] or 0, r[3]))
        assert [(r[0] is None, r[0] or 0, r[3]) for r in own] == deviations
        assert all(r[2] == n and abs(r[5] - e[m - 1] / np.trace(c.T @ c / n)) < 1e-10 and r[6] < 1e-10 for r in own)
        alone = min(abs(e[m - 1] - e[j]) for j in range(d) if j != m - 1) > 1e-3 * e[0] if d > 1 else True
        if alone:
            theirs = c @ u[:, m - 1] / math.sqrt(e[m - 1])
            want = sorted((round(abs(x), 7) for x in theirs))
            assert np.allclose(sorted(abs(r[4]) for r in own), want, atol=1e-6)


def wide_rows(n, d, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, d)) * np.linspace(3, 0.2, d) @ np.linalg.qr(rng.standard_normal((d, d)))[0]
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(v)]


def test_all_dimensions_and_fewer(spark):
    rows = wide_rows(200, 6)
    check(run(spark, rows), rows)
    check(run(spark, rows, components=2), rows, 2)


def test_more_dimensions_than_the_basis_holds(spark):
    rows = wide_rows(300, 40)
    check(run(spark, rows, components=4), rows, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = wide_rows(50, 3) + [(60, None), (61, [nan, 1.0, 2.0]), (62, [None, 1.0, 2.0]), (63, [inf, 0.0, 0.0]), (64, [0.0, -inf, 0.0])]
    rows += [(None, [0.5, -0.25, 9.0])] + [rows[3]] * 20
    check(run(spark, rows), rows)


def test_dependent_dimensions_are_left_out(spark):
    rng = random.Random(3)
    rows = [(i, [float(a), float(2 * a), float(b), 7.0]) for i, (a, b) in enumerate((rng.randrange(9), rng.randrange(9)) for _ in range(80))]
    check(run(spark, rows), rows)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, [0.5, 2.0])], [(i, [0.5, 2.0]) for i in range(9)], [(1, []), (2, [])], [(1, None)]):
        assert run(spark, rows) == []


def test_unequal_lengths_are_refused(spark):
    with pytest.raises(ValueError, match="1 to 2"):
        run(spark, [(1, [1.0, 2.0]), (2, [1.0])])


def test_far_from_the_origin(spark):
    rows = [(i, [c + 10_000.0 for c in v]) for i, v in wide_rows(100, 5)]
    check(run(spark, rows), rows)


@pytest.mark.parametrize(("d", "k", "spread"), [(64, 32, 1.0), (300, 16, 1e-3), (50, 50, 1.0), (200, 5, 0.0), (30, 4, 1e9)])
def test_pairs_reach_double_precision(d, k, spread):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = 1 + spread * np.sort(rng.random(d))[::-1]
    a = (q * e) @ q.T
    passes = []
    values, vectors = whitening.leading_pairs(lambda x: passes.append(x.shape[1]) or a @ x, d, k)
    assert np.allclose(values, e[:k], rtol=1e-13) and np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13)
    assert (np.linalg.norm(a @ vectors - vectors * values, axis=0) <= 128 * whitening.EPS * e[0]).all()
    assert max(passes) <= k
