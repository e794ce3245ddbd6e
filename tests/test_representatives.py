import numpy as np
import pytest

from conceptloom.operators import frames


def test_rounds_over_parts_equal_lloyd_on_all_rows(spark):
    rng = np.random.default_rng(5)
    data = {"a": rng.normal(size=(300, 3)), "b": rng.normal(size=(3, 3)), "c": rng.normal(size=(90, 3)) + 4}
    df = spark.createDataFrame([(s, i, x.tolist()) for s, v in data.items() for i, x in enumerate(v)], "s string, i int, v array<double>")
    got = {(x.s, x.cluster): x.centre for x in frames.kmeans_centres(df, "s", "i", "v", 4, part=40).collect()}
    want = {(s, c): x for s, v in data.items() for c, x in enumerate(frames.kmeans(v, 4)[1])}
    assert got.keys() == want.keys()
    assert all(got[x] == pytest.approx(want[x]) for x in want)


def test_centres_are_of_all_rows(spark):
    """One far item among 20,300: every item counts for the centres."""
    v = np.random.default_rng(6).normal(0, 0.1, (20_300, 1))
    df = spark.createDataFrame([(0, i, x.tolist()) for i, x in enumerate(v)], "s int, i int, v array<double>")
    got = frames.representatives(df, "s", "i", "v", 1).collect()
    assert [(x.i, x.size) for x in got] == [(int(np.abs(v - v.mean()).argmin()), 20_300)]
    assert got[0].distance == pytest.approx(np.abs(v - v.mean()).min(), abs=1e-9)


def test_the_densest_text_overrides_the_nearest(spark):
    rows = [("over", 0, [0.0], 10.0), ("over", 1, [1.0], 20.0), ("over", 2, [-1.1], 61.0), ("low", 0, [0.0], 10.0), ("low", 1, [1.0], 60.0), ("low", 2, [-1.1], None)]
    rows += [("half", 0, [0.0], 40.0), ("half", 1, [1.0], 80.0), ("half", 2, [-1.1], float("nan"))]
    df = spark.createDataFrame(rows, "s string, i int, v array<double>, t double")
    assert {x.s: x.i for x in frames.representatives(df, "s", "i", "v", 1, "t").collect()} == {"over": 2, "low": 0, "half": 0}
    assert {x.i for x in frames.representatives(df, "s", "i", "v", 1).collect()} == {0}
