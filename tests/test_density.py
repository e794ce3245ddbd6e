import numpy as np

from conceptloom.operators import clusters, topics


def test_a_large_scope_has_one_tree(spark):
    """Two broad clusters and twenty of four points each, in one scope of 5,280 rows: none is split, none is noise."""
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0], [100, 0], *[[10 * i, 200] for i in range(20)]], dtype=float)
    owner = np.repeat(np.arange(22), [2600, 2600, *[4] * 20])
    v = centres[owner] + rng.uniform(-0.5, 0.5, (len(owner), 2)) * np.where(owner < 2, 4, 0.1)[:, None]
    df = spark.createDataFrame([(0, i, x.tolist()) for i, x in enumerate(v)], "s int, i int, v array<double>")
    small = range(5200, len(v))
    for got in (clusters.clustered(df, "s", "i", "v", 3), topics.topic_clusters(df, "s", "i", "v", 3)):
        label = {x[1]: x[2] for x in got.collect()}
        by_owner = [{label[i] for i in small if owner[i] == k} for k in range(2, 22)]
        assert all(len(x) == 1 for x in by_owner) and len(set.union(*by_owner)) == 20
        assert got.columns[2] == "topic" or -1 not in set.union(*by_owner)
