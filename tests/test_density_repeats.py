import tracemalloc

import numpy as np

from conceptloom.operators import topics
from conceptloom.operators.clusters import density_clusters, density_tree


def peak_mb(points, least):
    tracemalloc.start()
    labels = density_clusters(points, least)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return labels, peak


def one_by_one(points, least):
    """The tree's edges as Prim's algorithm finds them, point by point."""
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    reach = np.maximum(apart, np.maximum.outer(core := np.sort(apart, axis=1)[:, least], core))
    best, near, edges, at, inside = np.full(len(points), np.inf), np.zeros(len(points), int), [], 0, {0}
    while len(inside) < len(points):
        for i in range(len(points)):
            if i not in inside and reach[at, i] < best[i]:
                best[i], near[i] = reach[at, i], at
        nxt = min((i for i in range(len(points)) if i not in inside), key=lambda i: (best[i], i))
        edges.append((best[nxt], near[nxt], nxt))
        at = nxt
        inside.add(at)
    return sorted(edges)


def test_repeated_points_give_the_tree_of_all_points():
    rng = np.random.default_rng(6)
    for k in range(30):
        points = rng.integers(0, 2 + k % 5, (int(rng.integers(5, 60)), 1 + k % 3)).astype(np.float32 if k % 2 else float)
        for least in (2, 3):
            w, a, b = density_tree(points, least)
            want = one_by_one(points.astype(float), least)
            assert [(x[1], x[2]) for x in want] == list(zip(a, b)) and np.allclose([x[0] for x in want], w)


def test_a_scope_of_many_names_takes_little_memory():
    """As in a hot chapter: hashed names of which many are equal; and a scope without any repeats."""
    rng = np.random.default_rng(7)
    kinds = rng.normal(size=(300, 64)).astype(np.float32)
    points = kinds[rng.integers(0, 300, 6_000)]
    labels, peak = peak_mb(points, 3)
    assert peak < 30 and len(set(labels)) == 300 and -1 not in labels
    assert peak_mb(rng.normal(size=(2_500, 8)), 3)[1] < 60


def test_topics_are_clustered_once(spark):
    df = spark.createDataFrame([(0, i, [float(i // 4), 0.0]) for i in range(12)], "s int, i int, v array<double>")
    got = topics.topic_clusters(df, "s", "i", "v", 3)
    assert "FlatMapGroupsInPandas" not in got._jdf.queryExecution().toString()  # written once, not once for each use
    assert [x.topic for x in got.orderBy("i").collect()] == [0] * 4 + [1] * 4 + [2] * 4
