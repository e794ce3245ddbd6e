import numpy as np
from pyspark.sql import functions as F

from conceptloom.config import EngineConfig
from conceptloom.operators import resolve
from conceptloom.operators.clusters import density_clusters

RAW = "concept_id string, chapter_id string, name string, type string, definition string, domain string, segment_id string, source_type string, confidence double, frequency int, concept_seq long"


def concepts(spark, names, chapter="k"):
    rows = [(f"c{i}", chapter, n, "fact", f"d{i}", "optics", f"s{i % 3}" if i % 4 else None, "text", [0.5, None, 2.0 / 3][i % 3], [1, 3, None][i % 3], i) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, RAW)


def by_hand(names, vector_of, said, config):
    """Groups as the sequential algorithm finds them: leaders, clusters of the commonest names, triage, decider."""
    norm = lambda s: "".join(ch for ch in s.lower().strip() if ch.isalnum() or ch == " ")
    groups, taken = [], set()
    for i in range(len(names)):
        if i not in taken:
            own = [j for j in range(i, len(names)) if j not in taken and resolve.indel_ratio(norm(names[i]), norm(names[j])) >= config.lexical_ratio]
            taken |= set(own)
            groups.append(own)
    mode = [max(dict.fromkeys(names[i] for i in g), key=[names[i] for i in g].count) for g in groups]
    points = np.array([vector_of[m] for m in mode])
    out = {}
    for c, own in ((c, [k for k, x in enumerate(density_clusters(points, config.min_cluster)) if x == c]) for c in sorted(set(density_clusters(points, config.min_cluster)))):
        low = min((float(points[a] @ points[b]) for a in own for b in own if a < b), default=1.0)
        members = [i for k in own for i in groups[k]]
        if c >= 0 and len(own) > 1 and (low >= config.merge_similarity or (low >= config.check_similarity and said.get(low > 0.8))):
            parts = [members]
        elif c >= 0 and len(own) > 1 and low >= config.check_similarity:
            parts = [[i] for i in members]
        else:
            parts = [groups[k] for k in own]
        for p in parts:
            out |= {f"c{i}": frozenset(f"c{j}" for j in p) for i in p}
    return out


def test_from_raw_names_to_groups(spark):
    at = lambda deg: [float(np.cos(np.radians(deg))), float(np.sin(np.radians(deg)))]
    angles = {"snells law": 0, "refraction rule": 5, "bending rule x": 8, "ohms law": 90, "voltage current y": 110, "resistance z": 125, "mole": 200, "molar mass of it": 232, "gas": 290}
    names = ["Snells Law", "snell's law", "snells laws", "refraction rule", "bending rule x", "ohms law", "Ohms Law!", "voltage current y", "resistance z", "mole", "molar mass of it", "gas", "gas"]
    vector_of = {n: at(angles[{"snells law": "snells law", "snell's law": "snells law", "snells laws": "snells law", "ohms law!": "ohms law"}.get(n.lower(), n.lower())]) for n in names}
    df, config = concepts(spark, names), EngineConfig()
    lexical = resolve.lexical_groups(df, config).select("concept_id", F.col("leader_seq").alias("group"))
    modes = {r.group: r.name for r in resolve.mode_names(df, lexical).collect()}
    vectors = spark.createDataFrame([("k", g, vector_of[n]) for g, n in modes.items()], "chapter_id string, group long, embedding array<double>")
    clusters = resolve.semantic_clusters(df, lexical, config, vectors)
    keys = [f"{r.chapter_id}/{r.cluster}" for r in clusters.filter("fate = 'check'").collect()]
    for reply, yes in ((None, False), ("Yes, the same", True), ("no", False)):
        replies = spark.createDataFrame([(k, reply) for k in set(keys)], "key string, reply string")
        got: dict = {}
        for r in resolve.resolved_groups(df, replies, config, vectors).collect():
            got.setdefault(r.group, set()).add(r.concept_id)
        want = by_hand(names, vector_of, {True: yes, False: yes}, config)
        assert {c: frozenset(m) for m in got.values() for c in m} == want
    asked = resolve.decider_names(df, clusters, lexical)
    assert asked.count() == len(set(keys)) and all(r.names.startswith('"') for r in asked.collect())


def test_canonical_lists_in_the_order_seen(spark):
    df = concepts(spark, ["B", "b", "B", "beta", None, ""])
    groups = spark.createDataFrame([(f"c{i}", 1 if i < 4 else 2) for i in range(6)], "concept_id string, group int")
    got = {r.group: r for r in resolve.canonical_concepts(df, groups).collect()}
    one = got[1]  # c2: no frequency counts as 1, score 0.7 * 2/3 + 0.1; c0 0.7 * 0.5 + 0.1; c1 0.3; c3 as c0
    assert (one.concept_id, one.name, one.frequency) == ("c2", "B", 6) and one.aliases == ["b", "beta"] and one.source_segments == ["s1", "s2", "s0"]
    assert abs(one.confidence - min(1.0, 0.7 * 2 / 3 + 0.3 * 6 / 3)) < 1e-9
    assert got[2].aliases == [] and got[2].frequency == 4
    assert sorted((r.old_id, r.canonical_id) for r in resolve.id_remap(df, groups).collect() if r.canonical_id == "c2") == [("c0", "c2"), ("c1", "c2"), ("c3", "c2")]
    assert resolve.canonical_concepts(df.filter("false"), groups).count() == 0


def test_one_large_chapter_in_blocks(spark):
    names = [f"name {i * 7919 % 10007:05d} {i % 13}" for i in range(900)]
    df = spark.createDataFrame([("k", i, n) for i, n in enumerate(names)], "s string, q long, n string")
    pairs = lambda block: {(r.seq_a, r.seq_b) for r in resolve.fuzzy_pairs(df, "s", "q", "n", 90.0, block=block).collect()}
    assert pairs(5) == pairs(2_000)  # 64 blocks to a cell at most, worked off in tiles
