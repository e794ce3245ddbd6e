import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptloom.operators import clusters, extract, frames, pairs, prereqs, resolve, segments
from conceptloom.operators.ordered import running_counts, with_previous
from conceptloom.operators.scans import running_extremes


@pytest.mark.parametrize("seed", range(3))
def test_running_counts_in_chunks(spark, seed):
    r = random.Random(seed)
    rows = [(k, i, r.random() < 0.2) for k in "ab" for i in sorted(r.sample(range(400), 120))]
    df = spark.createDataFrame(rows, "k string, i long, f boolean")
    got = {(x.k, x.i): x for x in running_counts(df, ["k"], ["i"], F.floor(F.col("i") / 17), F.col("f")).collect()}
    back = {(x.k, x.i): x.p for x in with_previous(df, ["k"], ["i"], F.floor(F.col("i") / 17), {"p": "i"}).collect()}
    for k in "ab":
        flags = since = 0
        before = None
        for n, (_, i, f) in enumerate(x for x in rows if x[0] == k):
            flags, since = (flags + 1, 0) if f else (flags, since + (n > 0))
            x = got[k, i]
            assert (x.n, x.flags, x.since) == (n, flags, since)
            assert back[k, i] == before
            before = i


def test_running_extremes_with_ties(spark):
    rows = [("k", float(o), float(v)) for o, v in [(1, 5), (1, 9), (2, 1), (700, 3), (700, 4), (1300, 2)]]
    df = running_extremes(spark.createDataFrame(rows, "k string, o double, v double"), ["k"], "o", F.floor(F.col("o") / 600), max_before={"hi": "v"}, min_after={"lo": "v"})
    assert {(x.o, x.v): (x.hi, x.lo) for x in df.collect()} == {(1, 5): (None, 1), (1, 9): (None, 1), (2, 1): (9, 2), (700, 3): (9, 2), (700, 4): (9, 2), (1300, 2): (9, None)}


def lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


@pytest.mark.parametrize("threshold,block", [(60.0, 2000), (60.0, 9), (85.0, 9), (95.0, 20)])
def test_fuzzy_pairs_lose_none(spark, threshold, block):
    r = random.Random(int(threshold))
    names = {"", "a", "ab"}
    while len(names) < 70:
        base = "".join(r.choice("abc ") for _ in range(r.randrange(1, 22)))
        names |= {base, base[1:], base + r.choice("abc"), base[: len(base) // 2] + "x" + base[len(base) // 2 :]}
    rows = list(enumerate(sorted(names)))
    got = {(x.seq_a, x.seq_b): x.ratio for x in resolve.fuzzy_pairs(spark.createDataFrame([("s", i, n) for i, n in rows], "scope string, seq int, name string"), "scope", "seq", "name", threshold, block=block).collect()}
    want = {}
    for i, a in rows:
        for j, b in rows[i + 1 :]:
            ratio = 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0
            assert abs(resolve.indel_ratio(a, b) - ratio) < 1e-9
            if ratio >= threshold:
                want[i, j] = ratio
    assert got == pytest.approx(want)


def test_leaders_equal_the_sequential_greedy(spark):
    for seed in range(3):
        r = random.Random(seed)
        n = 30
        similar = {(i, j) for i in range(n) for j in range(i + 1, n) if r.random() < 0.1}
        leader, heads = {}, []
        for j in range(n):
            leader[j] = next((h for h in heads if (h, j) in similar), j)
            if leader[j] == j:
                heads.append(j)
        p = spark.createDataFrame([("s", i, j) for i, j in similar], "scope string, seq_a int, seq_b int")
        items = spark.createDataFrame([("s", i) for i in range(n)], "scope string, seq int")
        assert {x.seq: x.leader for x in resolve.leaders(p, items, "scope", "seq").collect()} == leader


def test_similar_pairs_are_exact(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(120, 6))
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(i % 2, i, x.tolist()) for i, x in enumerate(v)], "s int, i int, v array<double>")
    for threshold in (0.2, 0.8):
        got = {(x.seq_a, x.seq_b) for x in pairs.similar_pairs(df, "s", "i", "v", threshold, block=13).collect()}
        assert got == {(i, j) for i in range(120) for j in range(i + 1, 120) if i % 2 == j % 2 and v[i] @ v[j] >= threshold}
    low = {x.s: x.least for x in pairs.least_similarity(df, "s", "i", "v", block=13).collect()}
    assert low == pytest.approx({k: min(v[i] @ v[j] for i in range(k, 120, 2) for j in range(k, i, 2)) for k in (0, 1)})


@pytest.mark.parametrize("most", [0, 10**6])
def test_cycles_and_depths_both_ways(spark, most):
    for seed in range(2):
        r = random.Random(seed)
        edges = sorted({(r.randrange(12), r.randrange(12)) for _ in range(26)})
        rows = [("s", f"{a:02}", f"{b:02}", round(r.random(), 2)) for a, b in edges if a != b] + [("t", "1", "2", 0.5), ("t", "2", "1", 0.5)]
        df = spark.createDataFrame(rows, "chapter_id string, source string, target string, confidence double")
        dag = prereqs.break_cycles(df, most=most)
        kept = {(x.chapter_id, x.source, x.target) for x in dag.collect()}
        assert ("t", "2", "1") in kept and ("t", "1", "2") not in kept
        depth = {(x.chapter_id, x.node): x.depth for x in prereqs.depths(dag, most=most).collect()}
        assert min(depth.values()) == 0
        for ch, s, t in kept:
            assert depth[ch, t] > depth[ch, s]
        for (ch, node), k in depth.items():
            assert k == max((depth[c, s] + 1 for c, s, t in kept if (c, t) == (ch, node)), default=0)
        with_cycle = {x.node: x.depth for x in prereqs.depths(df.filter("chapter_id = 't'"), most=most).collect()}
        assert with_cycle == {"1": -1, "2": -1}


def test_parsers(spark):
    text = "# note\r\nA | Law | d | more\nB|nothing|e\nonly|two\n" + "x" * 121 + "|fact|f\n\n" + "y" * 120 + "|fact|g C|fact|h"
    df = spark.createDataFrame([("k", text), ("n", None), ("e", "")], "k string, t string")
    got = [(x.name, x.type, x.definition) for x in extract.concept_lines(df, "k", "t", 3).orderBy("line_no").collect()]
    assert got == [("A", "law", "d"), ("B", "fact", "e"), ("y" * 120, "fact", "g")]
    df = spark.createDataFrame([("k", "a|Leads To|b|0.9\nc|odd|d\n|requires|e\nf|requires|g|7")], "k string, t string")
    assert [(x.source_name, x.relation, x.confidence) for x in extract.relation_lines(df, "k", "t").orderBy("line_no").collect()] == [("a", "leads_to", 0.9), ("c", "explains", 0.8), ("f", "requires", 1.0)]
    assert extract.prerequisite_lines(df, "k", "t", 1).count() == 1
    df = spark.createDataFrame([("k", "Q: one?\nA: two\nWrong: x, , y\nA: three"), ("q", "Q: one?")], "k string, t string")
    got = extract.question_lines(df, "k", "t")
    assert [(x.question, x.answer, x.wrong) for x in got.collect()] == [("one?", "three", ["x", "y"])]
    assert extract.question_concepts(got, "k").count() == 3 and extract.question_relations(got, "k").count() == 2


def test_split_long_slices(spark):
    text = " ".join(str(i) for i in range(23))
    df = spark.createDataFrame([("u", 0.0, 9.0, text), ("short", 0.0, 1.0, "a b"), ("few", 0.0, 9.0, "a b"), ("null", 0.0, 9.0, None)], "unit_id string, span_start double, span_end double, text string")
    got = [(x.unit_id, x.k, x.slice_text) for x in segments.split_long(df, 4.0, 5).orderBy("unit_id", "k").collect()]
    assert [g[:2] for g in got] == [("few", 0), ("u", 0), ("u", 1), ("u", 2)]
    assert " ".join(g[2] for g in got[1:]) == text


def test_density_clusters_and_change_points():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(0, 0.05, (20, 2)), rng.normal(3, 0.05, (20, 2)), [[10.0, -10.0]]])
    labels = clusters.density_clusters(points, 4)
    assert len(set(labels[:20])) == len(set(labels[20:40])) == 1 and labels[0] != labels[20] and labels[40] == -1
    assert (clusters.density_clusters(points[:3], 4) == -1).all()
    series = np.concatenate([np.zeros((30, 1)), np.ones((30, 1)) * 5]) + rng.normal(0, 0.01, (60, 1))
    assert clusters.change_points(series, 2.0) == [30]
    assert clusters.change_points(series[:3], 2.0) == []


def test_kmeans_and_quality(spark):
    labels, centres = frames.kmeans(np.array([[0.0], [0.1], [5.0], [5.1]]), 2)
    assert labels[0] == labels[1] != labels[2] == labels[3] and len(centres) == 2
    reason = frames.quality_reason(F.col("m"), F.col("s"), F.col("f"), 10, 20, 50, 0.5)
    df = spark.createDataFrame([(5.0, 99.0, 0.0), (50.0, 5.0, 0.0), (50.0, 30.0, 0.9), (50.0, 30.0, 0.1), (None, None, None)], "m double, s double, f double")
    assert [x.r for x in df.select(reason.alias("r")).collect()] == ["dark", "blurred", "face", "keep", "keep"]


def test_overlap_join_equals_comparing_all(spark):
    r = random.Random(3)
    spot = lambda: r.choice([0.0, r.uniform(-50, 50), r.uniform(0, 5000), float(r.randrange(60))])
    spans = [(f"s{i}", r.choice("ab"), spot(), spot()) for i in range(60)] + [("all", "a", 0.0, 0.0), ("null", "a", None, 1.0), ("nan", "a", float("nan"), 1.0), ("wide", "b", -1e6, 1e7)]
    cues = [(f"c{i}", r.choice("ab"), a, a + r.choice([-3.0, 0.0, 2.0, 900.0])) for i in range(90) for a in [spot()]] + [("null", "a", 1.0, None)]
    got = sorted((x.id, x.cue) for x in segments.overlapping(spark.createDataFrame(spans, "id string, entity string, start double, stop double"), spark.createDataFrame(cues, "cue string, entity string, start double, stop double")).collect())
    assert got == sorted((i, c) for i, e, a, b in spans for c, f, x, y in cues if e == f and ((a, b) == (0.0, 0.0) or (None not in (a, b, x, y) and y >= a and x <= b)))
    texts = spark.createDataFrame([("a", 1.0, 2.0, 1, " one "), ("a", 5.0, 6.0, 2, "two"), ("a", 7.0, 8.0, 3, "")], "entity string, start double, stop double, place int, text string")
    units = spark.createDataFrame([("u", "a", 4.0, 9.0), ("v", "a", 50.0, 60.0), ("w", "b", 0.0, 9.0), ("x", "a", 0.0, 0.0)], "unit_id string, entity string, start double, stop double")
    assert {x.unit_id: x.text for x in segments.transcript_texts(units, texts).collect()} == {"u": "two", "v": "one two", "w": None, "x": "one two"}
