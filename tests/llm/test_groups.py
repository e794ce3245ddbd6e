import random
from datetime import datetime

import pytest

from conceptloom.llm.components import concept_groups, consolidate
from conceptloom.llm.survivors import choose_survivors, merged_aliases, merged_concepts

CONCEPT = (
    "concept_id string, name string, type string, definition string, domain string, chapter_id string, source_type string, confidence double, frequency int, extracted_at timestamp, group_id string, trust int"
)


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


def groups(spark, links):
    return {r.concept_id: r.group_id for r in consolidate(spark.createDataFrame(links, "a string, b string, v int" if links and len(links[0]) == 3 else "a string, b string")).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    r = random.Random(seed)
    links = [(f"n{r.randrange(80):03}", f"n{r.randrange(80):03}") for _ in range(60)]
    assert groups(spark, links) == brute(links)


def test_long_chain_star_and_cycle(spark):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(200)]
    random.Random(1).shuffle(chain)
    star = [("s000", f"s{i:03}") for i in range(1, 300)]
    ring = [("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("r2", "r1"), ("r1", "r1")]
    links = chain + star + ring + star[:3]
    assert groups(spark, links) == brute(links)


def test_nothing_linked(spark):
    assert groups(spark, []) == {}
    assert groups(spark, [("a", "a"), (None, "b"), ("c", None)]) == {}


def concepts(spark, rows):
    base = dict(name=None, type="fact", definition=None, domain="d", chapter_id="x", source_type=None, confidence=None, frequency=None, extracted_at=None, group_id="clash", trust=7)
    return spark.createDataFrame([tuple({"concept_id": None, **base, **r}[c.split()[0]] for c in CONCEPT.split(", ")) for r in rows], CONCEPT)


def remap(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "old_id string, canonical_id string, id string")


def test_links_of_concepts(spark):
    raw = concepts(spark, [dict(concept_id=" A ", name="Same  name"), dict(concept_id="b", name=" same\tNAME"), dict(concept_id="c", name="same name", chapter_id="y"), dict(concept_id="d", name=""), dict(concept_id="e", name=" "), dict(concept_id="f"), dict(concept_id="g", name="same name", chapter_id=None), dict(concept_id=None, name="same name"), dict(concept_id="b", name=" same\tNAME")])
    pairs = remap(spark, [("B ", "only"), ("only", "b"), ("x", "X "), ("", "b"), (None, "b"), ("b", "\t"), ("d", None)])
    assert {r.concept_id: r.group_id for r in concept_groups(pairs, raw).collect()} == {"a": "a", "b": "a", "only": "a"}


def test_survivors(spark):
    at = datetime(2025, 1, 1)
    rows = [
        dict(concept_id="a", confidence=1.5, frequency=9, definition=" long definition ", name="Other"),
        dict(concept_id="b", confidence=0.5, frequency=None, definition="0123456789", name="N"),
        dict(concept_id="c", confidence=0.5, frequency=2, extracted_at=None, definition="          ", name="n "),
        dict(concept_id="D", confidence=0.5, frequency=2, extracted_at=at, definition=None, name=" other", trust=1),
        dict(concept_id="d ", confidence=0.5, frequency=2, extracted_at=at, definition=None, name=" other", trust=2),
        dict(concept_id="p", confidence=float("nan"), definition="x" * 50_000),
        dict(concept_id="q", confidence=None, definition="x" * 50_000, name="Q"),
        dict(concept_id="single", confidence=1.0),
    ]
    raw = concepts(spark, rows)
    groups = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("only", "a"), ("p", "p"), ("q", "p"), ("single", "single"), ("x", "single")], "concept_id string, group_id string")
    got = {r.group_id: (r.survivor_id, r.definition_id) for r in choose_survivors(raw, groups).collect()}
    assert got == {"a": ("d", "a"), "p": ("p", "p")}
    merged = {r.group_id: r for r in merged_concepts(raw, groups).collect()}
    assert (merged["a"].n_members, merged["a"].frequency, merged["a"].definition) == (4, 13, "long definition")
    assert {(r.group_id, r.alias) for r in merged_aliases(raw, groups).collect()} == {("a", "N"), ("p", "Q")}
    assert choose_survivors(raw.filter("false"), groups).count() == 0 and choose_survivors(raw, groups.filter("false")).count() == 0


def test_one_group_of_all_rows_is_ranked_in_parts(spark):
    raw = concepts(spark, [dict(concept_id=f"{i:05}", confidence=(i * 7919 % 1000) / 1000, name=f"n{i % 10}") for i in range(3000)])
    groups = raw.select("concept_id").selectExpr("concept_id", "'00000' as group_id")
    assert choose_survivors(raw, groups).collect()[0].survivor_id == min(f"{i:05}" for i in range(3000) if i * 7919 % 1000 == 999)
    assert merged_aliases(raw, groups).count() == 9
