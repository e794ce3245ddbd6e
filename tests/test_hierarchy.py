import random

import pytest

from conceptloom.operators.hierarchy import descendants, prerequisite_links, resolve_trees

LINK = "chapter_id string, child string, parent string"


def trees(spark, links, **kw):
    return {(r.chapter_id, r.node): r for r in resolve_trees(spark.createDataFrame(links, LINK), **kw).collect()}


def plain(links):
    parent = {}
    for ch, c, p in links:
        parent[ch, c] = min(p, parent.get((ch, c), p))
    out = {}
    for node in {(ch, x) for ch, c, p in links for x in (c, p)}:
        at, path = node, [node[1]]
        while at in parent and len(path) <= len(links) + 1:
            at = (at[0], parent[at])
            path.append(at[1])
        out[node] = ("", -1, None) if at in parent else (at[1], len(path) - 1, " > ".join(reversed(path)))
    return out


def test_chain_cycle_and_below(spark):
    links = [("x", f"n{i}", f"n{i - 1}") for i in range(1, 38)]
    links += [("x", "a", "b"), ("x", "b", "a"), ("x", "under", "a"), ("x", "self", "self"), ("y", "n1", "z"), ("y", "n1", "z")]
    got = trees(spark, links, with_path=True)
    assert {k: (r.root, r.depth, r.path) for k, r in got.items()} == plain(links)
    assert got["x", "n37"].depth == 37 and got["x", "under"].root == "" and got["x", "self"].depth == -1


@pytest.mark.parametrize("seed", range(3))
def test_random_forests(spark, seed):
    r = random.Random(seed)
    links = [(f"c{r.randrange(2)}", f"n{i}", f"n{r.randrange(30)}") for i in range(30) if r.random() < 0.8]
    assert {k: (x.root, x.depth) for k, x in trees(spark, links).items()} == {k: v[:2] for k, v in plain(links).items()}
    want = {(ch, a, n, len(path.split(" > ")) - 1 - i) for (ch, n), (_, depth, path) in plain(links).items() if depth > 0 for i, a in enumerate(path.split(" > ")[:-1])}
    assert {tuple(x) for x in descendants(spark.createDataFrame(links, LINK)).select("chapter_id", "ancestor", "descendant", "distance").collect()} == want


def test_only_cycles_and_empty(spark):
    assert {k: r.depth for k, r in trees(spark, [("x", "a", "b"), ("x", "b", "a")]).items()} == {("x", "a"): -1, ("x", "b"): -1}
    assert trees(spark, []) == {}
    assert descendants(spark.createDataFrame([], LINK)).count() == 0


def test_two_parents_count_as_the_smaller(spark):
    assert trees(spark, [("x", "c", "p2"), ("x", "c", "p1")])["x", "c"].root == "p1"


def test_links_of_relations(spark):
    rows = [
        ("A  b ", " Requires\t", "C", None, "x", 1, 2), ("a b", "explains", "c", True, "x", 1, 2), ("d", "explains", "c", None, "x", 1, 2), ("", "requires", "c", True, "x", 1, 2),
        (None, "requires", "c", True, "x", 1, 2), ("d", "requires", " ", True, "x", 1, 2), ("e", None, "f", True, None, 1, 2), ("long" * 5000, "requires", "c", False, "x", 1, 2),
    ]
    df = spark.createDataFrame(rows, "source_name string, relation string, target_name string, is_prereq boolean, chapter_id string, node int, depth int")
    assert {tuple(r) for r in prerequisite_links(df).collect()} == {("x", "a b", "c"), ("", "e", "f"), ("x", "long" * 5000, "c")}
