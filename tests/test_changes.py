import itertools

import numpy as np
import pytest

from conceptloom.operators import clusters


def test_changes_are_searched_over_the_whole_scope(spark):
    """A change at row 2,000, and a scope whose rows lie 1,000 apart."""
    rng = np.random.default_rng(2)
    v = rng.normal(0, 0.05, (4000, 12))
    v[2000:, 0] += 5
    w = rng.normal(0, 0.05, (60, 12))
    w[40:, 1] += 5
    rows = [("a", i, x.tolist()) for i, x in enumerate(v)] + [("b", i * 1000, x.tolist()) for i, x in enumerate(w)]
    df = spark.createDataFrame(rows, "s string, i long, v array<double>")
    assert {(x.s, x.i) for x in clusters.change_boundaries(df, "s", "i", "v").collect()} == {("a", 2000), ("b", 40_000)}


def test_only_ten_principal_axes_are_kept():
    rng = np.random.default_rng(3)
    v = rng.normal(0, 1, (40, 64))
    distance = lambda x: ((x[:, None] - x[None]) ** 2).sum(axis=2)
    u, s, _ = np.linalg.svd(v - v.mean(axis=0), full_matrices=False)
    assert distance(clusters.principal(v)) == pytest.approx(distance(u[:, :10] * s[:10]))
    assert distance(clusters.principal(v[:, :12])) != pytest.approx(distance(v[:, :12]))
    assert distance(clusters.principal(v[:, :6])) == pytest.approx(distance(v[:, :6]))


@pytest.mark.parametrize("seed", range(3))
def test_change_points_are_the_best_partition(seed):
    rng = np.random.default_rng(seed)
    points = np.repeat(rng.normal(0, 2, (3, 2)), [4, 3, 4], axis=0) + rng.normal(0, 0.3, (11, 2))
    sq = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    gram = np.exp(-np.where(np.eye(11, dtype=bool), 0, np.clip(sq / np.median(sq[np.triu_indices(11, 1)]), 1e-2, 1e2)))
    cost = lambda cuts: sum(b - a - gram[a:b, a:b].sum() / (b - a) + 0.8 for a, b in itertools.pairwise((0, *cuts, 11)))
    want = min((c for k in range(11) for c in itertools.combinations(range(1, 11), k)), key=cost)
    assert tuple(clusters.change_points(points, 0.8)) == want


@pytest.mark.parametrize("n", [4, 5, 30, 1203])
def test_median_of_pairs_is_exact(n):
    points = np.random.default_rng(n).normal(size=(n, 3)).round(1)
    sq = ((points[:, None] - points[None]) ** 2).sum(axis=2)[np.triu_indices(n, 1)]
    for room in (1, 50, 10**7):
        assert clusters.pair_median(points, room) == pytest.approx(np.median(sq), abs=0)


def test_equal_points_have_no_changes():
    assert clusters.change_points(clusters.principal(np.full((503, 64), 0.1)), 5) == []
