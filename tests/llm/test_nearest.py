import random

import pytest

from conceptloom.llm.nearest import all_frames, nearest_match

SPAN = "entity string, a double, b double, item string"
LEFT = "key string, entity string, at double"


def brute(left, spans, tolerance):
    out = {}
    for key, entity, t in left:
        if t is None:
            continue
        best = None
        for e, a, b, item in spans:
            if e != entity or a is None or b is None:
                continue
            d = max(0.0, min(a, b) - t, t - max(a, b))
            if d <= tolerance:
                best = min(best or (d, abs(t - a), item), (d, abs(t - a), item))
        if best:
            out[key] = (best[2], best[0])
    return out


def run(spark, left, spans, tolerance=2.5):
    got = nearest_match(spark.createDataFrame(left, LEFT), spark.createDataFrame(spans, SPAN).dropna(), tolerance)
    return {r.key: (r.item, r.distance) for r in got.collect()}


@pytest.mark.parametrize("seed", range(6))
def test_random_spans(spark, seed):
    """Overlapping, nested, reversed and equal spans, ties at midpoints, times on all ends; halves make ties exact."""
    r = random.Random(seed)
    size = r.choice([20, 60, 2000])
    spans = []
    for i in range(60):
        a = r.randrange(2 * size) / 2
        b = a + r.choice([0, 0.5, 1, 3, 3, 10, size / 3]) * r.choice([1, 1, 1, -1])
        spans.append((r.choice("vw"), a, b, f"u{i:02}"))
    spans += spans[:5] + [("v", 1.0, 1.0, "twin2"), ("v", 1.0, 1.0, "twin1")]
    left = [(f"f{i}", r.choice("vwx"), r.randrange(-10, 4 * size + 20) / 4) for i in range(400)]
    assert run(spark, left, spans) == brute(left, spans, 2.5)


def test_ties(spark):
    spans = [("v", 0.0, 1.0, "a"), ("v", 3.0, 4.0, "b"), ("v", 6.0, 5.0, "c")]
    # at 2 both are 1 away; b begins nearer. at 4.5 b begins 1.5 away, c begins 1.5 away: the smaller id.
    assert run(spark, [("x", "v", 2.0), ("y", "v", 4.5), ("z", "v", 8.5), ("far", "v", 8.51)], spans) == {"x": ("b", 1.0), "y": ("b", 0.5), "z": ("c", 2.5)}


def test_hot_entity_and_one_long_span(spark):
    spans = [("v", float(i), i + 1.5, f"u{i:05}") for i in range(3000)] + [("v", 0.0, 1e6, "whole")]
    left = [(f"f{i}", "v", i * 0.75) for i in range(4000)]
    some = left[:: 40]
    assert {k: v for k, v in run(spark, left, spans).items() if k in {x[0] for x in some}} == brute(some, spans, 2.5)


def test_deep_nesting_leaves_few_candidates(spark):
    from conceptloom.llm.nearest import _distinct_spans, whole_cells
    from conceptloom.runtime import Scratch

    spans = [("v", float(i), 40_000.0 - i, f"u{i:05}") for i in range(0, 19_000, 10)] + [("v", 40_000.0 - i - 5, float(i), f"r{i:05}") for i in range(0, 19_000, 190)]
    left = [(f"f{i}", "v", i * 7.3) for i in range(5500)]
    some = left[::60]
    assert {k: v for k, v in run(spark, left, spans).items() if k in {x[0] for x in some}} == brute(some, spans, 2.5)
    cells = whole_cells(_distinct_spans(spark.createDataFrame(spans, SPAN), Scratch(spark, "test")))
    assert cells.groupBy("entity", "class", "cell").count().agg({"count": "max"}).first()[0] <= 2


def test_nothing_to_match(spark):
    assert run(spark, [], [("v", 0.0, 1.0, "a")]) == {}
    assert run(spark, [("x", "v", 1.0)], []) == {}
    assert run(spark, [("x", "v", float("nan")), ("y", None, 1.0), ("z", "v", None)], [("v", 0.0, 1.0, "a"), ("v", float("nan"), 1.0, "b"), (None, 0.0, 1.0, "c")]) == {}


def test_frames(spark):
    frames = spark.createDataFrame(
        [("f1", "v", 1.0, "k", 0), ("f1", "v", 1.0, "k", 0), ("f2", "v", None, "k", 0), ("f3", "v", 99.0, "k", 0), (None, "v", 1.0, "k", 0)], "frame_path string, video_path string, timestamp_sec double, key string, distance int"
    )
    units = spark.createDataFrame(
        [("u1", "v", "video", 0.0, 0.0), ("u2", "v", "pdf", 1.0, 1.0), ("u3", "v", "video", 2.0, 3.0), ("u4", "v", "video", 1.0, None)], "unit_id string, source_path string, source_type string, span_start double, span_end double"
    )
    got = {(r.frame_path, r.unit_id, r.distance) for r in all_frames(frames, units).collect()}
    assert got == {("f1", "u3", 1.0), ("f2", None, None), ("f3", None, None), (None, None, None)}
