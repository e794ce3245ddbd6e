from conceptloom.operators import graph, prereqs
from conceptloom.plans import pipeline

EDGE = "source string, target string, type string, confidence double, cross_domain boolean, chapter_id string"


def test_spellings_count_and_requires_edges_have_no_cycles(spark):
    canon = spark.createDataFrame(
        [(x, x, [], "optics", "k", 1, ["s"], i) for i, x in enumerate("abcd")],
        "concept_id string, name string, aliases array<string>, domain string, chapter_id string, frequency int, source_segments array<string>, concept_seq long",
    ).selectExpr("*", "CAST(NULL AS timestamp) AS deleted_at")
    rows = [("a", "REQUIRES", "b", 0.9), ("b", " requires", "c", 0.8), ("c", "Requires ", "a", 0.5), ("c", "requires", "d", 0.7), ("d", "Leads To", "a", 0.6), ("d", "odd", "b", 0.6)]
    rels = prereqs.plain_relations(spark.createDataFrame([(str(i), s, r, t, c, None, "k") for i, (s, r, t, c) in enumerate(rows)], "relation_id string, source_name string, relation string, target_name string, confidence double, is_prereq boolean, chapter_id string"))
    units = spark.createDataFrame([], "source_path string, chapter_id string, unit_id string")
    nodes = graph.graph_nodes(canon, units)
    edges = graph.graph_edges(nodes, rels, canon, prereqs.break_cycles(prereqs.prerequisite_edges(rels, canon)))
    got = {(x.source, x.type, x.target) for x in edges.collect() if x.type not in ("contains", "has_topic")}
    assert got == {("a", "requires", "b"), ("b", "requires", "c"), ("c", "requires", "d"), ("d", "leads_to", "a")}


def test_report_has_cycles_and_the_verdict(spark):
    nodes = spark.createDataFrame(
        [(f"{k}{i}", "AtomicConcept" if i > 2 else "TopicGodNode", k, 1) for k in "pqrs" for i in range(15)],
        "id string, type string, chapter_id string, n_evidence long",
    )
    chain = [(f"{k}{i}", f"{k}{i + 1}", "requires" if k != "s" else "explains", 1.0, False, k) for k in "pqr" for i in range(14)]
    chain += [("q14", "q0", "requires", 1.0, False, "q"), ("r14", "r0", "explains", 1.0, False, "r")]
    got = {(x.chapter_id, x.check): (x.passed, x.all_passed) for x in graph.quality_gates(nodes, spark.createDataFrame(chain, EDGE)).collect()}
    assert len(got) == 4 * 7
    assert [got[k, "dag_acyclic"] for k in "pqrs"] == [(True, True), (False, False), (True, False), (True, False)]
    assert [got[k, "graph_acyclic"] for k in "pqrs"] == [(True, True), (False, False), (False, False), (True, False)]
    assert got["s", "min_edges"] == (False, False) and got["r", "min_edges"] == (True, False)


def test_spelled_rows_reach_the_graph(spark, sf):
    whole, bare = pipeline.dag_graph_edges(spark, sf), pipeline.graph_edges(spark, sf)
    types = lambda df: {x.type: x["count"] for x in df.groupBy("type").count().collect()}
    a, b = types(whole), types(bare)
    assert {k: v for k, v in a.items() if k not in ("requires", "has_topic")} == {k: v for k, v in b.items() if k not in ("requires", "has_topic")}
    assert all(x.acyclic for x in prereqs.acyclic(whole.filter("type = 'requires'")).collect())
