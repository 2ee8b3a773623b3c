"""Whitening against dense linear algebra and exact integers."""

import math

import numpy as np
import pytest

from touchcredit.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, whitened double, component int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, 1.0, 2) for i, v in rows], SCHEMA).repartition(3)


def kept(rows):
    return [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def check(got, rows, components=32):
    rows = kept(rows)
    width = max(len(v) for _, v in rows)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array(x) - 1_000_000.0
    y -= y.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    k = min(components, int((values > 1e-9 * values.max()).sum()))
    assert len(got) == n * k
    want = {}
    for (i, _), r in zip(rows, x):
        want.setdefault(i, []).append(sum((n * c - s) ** 2 for c, s in zip(r, sums)))
    assert sorted((r.vec_id is None, r.vec_id, r.deviation) for r in got if r.component == 1) == sorted(
        (i is None, i, d) for i, ds in want.items() for d in ds)
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-4
    for c in range(1, k + 1):
        mine = [r for r in got if r.component == c]
        assert abs(mine[0].explained / (values[-c] / values.sum()) - 1) < 1e-6
        w = np.array([r.whitened for r in mine])
        assert abs((w ** 2).mean() - 1) < 1e-6 and abs(w.mean()) < 1e-9
        gap = min(abs(values[-c] - values[j]) for j in range(len(values)) if j != len(values) - c)
        if gap > 1e-6 * values[-c]:  # the direction is defined up to its sign
            direct = sorted((y @ vectors[:, -c] / math.sqrt(values[-c])).tolist())
            mirror = sorted((-w).tolist())
            assert min(np.abs(np.sort(w) - direct).max(), np.abs(mirror - np.array(direct)).max()) < 1e-6


def random_rows(n, width, seed=1):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(width, width))
    return [(i, (r.normal(size=width) @ mix / 4 + 3).astype(np.float32).tolist()) for i in range(n)]


def test_whole_table(spark):
    rows = random_rows(500, 40)
    check(whitening.whiten(table(spark, rows)).collect(), rows)


def test_rows_that_take_no_part_ties_and_repeats(spark):
    rows = random_rows(60, 6) + [(61, None), (62, [float("nan")] * 6), (63, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
                                 (64, [float("inf")] + [0.0] * 5), (3, [1.0] * 6), (None, [2.0] * 6), (3, [1.0] * 6),
                                 (65, [1.0, 2.0]), (66, [])]
    check(whitening.whiten(table(spark, rows)).collect(), rows)


def test_dependent_dimensions_give_fewer_components(spark):
    rows = [(i, [float(i % 7), float(i % 7), float(i % 5), 4.0]) for i in range(70)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, [])]])
def test_without_variance_there_are_no_rows(spark, rows):
    out = whitening.whiten(table(spark, rows))
    assert out.collect() == []
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries_are_held_to_a_bound(spark):
    rows = random_rows(40, 5) + [(99, [3e38, 0.0, 0.0, 0.0, 0.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 41 and max(r.identity_error for r in got) < 1e-4  # the others are lost beside 2^61
    assert {r.vec_id for r in got if r.deviation is None} == set(range(40)) | {99}
    rows = random_rows(40, 5) + [(99, [1e9, 0.0, 0.0, 0.0, 0.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 41 * 5 and max(r.identity_error for r in got) < 1e-4


def test_deviations_near_the_end_of_a_long():
    n = 10 ** 8
    fit = whitening.Fit(n, (3 * n + 5, -n // 2))
    y = np.array([[3, -1], [33, 0], [10 ** 5, 1], [3 + 30, -1]])
    want = [(n * a - fit.sums[0]) ** 2 + (n * b - fit.sums[1]) ** 2 for a, b in y.tolist()]
    assert whitening.deviations(y, fit).to_pylist() == [w if w < 2 ** 63 else None for w in want]


def test_factor_and_rotations():
    r = np.random.default_rng(5)
    for size, rank in ((1, 1), (7, 7), (30, 11), (65, 65)):
        b = r.normal(size=(size, rank)) * np.logspace(0, -4, rank)
        a = b @ b.T
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape == (size, rank) and np.abs(factor @ factor.T - a).max() < 1e-12 * a.max()
        values, vectors = whitening.one_sided_jacobi(factor)
        assert np.allclose(values, np.linalg.svd(b, compute_uv=False) ** 2, rtol=1e-6)
        assert np.abs(vectors.T @ vectors - np.eye(rank)).max() < 1e-10
        assert np.abs(a @ vectors - vectors * values).max() < 1e-10 * a.max()


def test_tasks_matrices_are_added_in_groups(spark):
    rows = random_rows(300, 8)
    df = table(spark, rows).repartition(100, "vec_id")
    check(whitening.whiten(df).collect(), rows)
    again = [sorted(map(repr, whitening.whiten(df).collect())) for _ in range(2)]
    assert again[0] == again[1]
