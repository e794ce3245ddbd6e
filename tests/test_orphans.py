from pyspark.sql import functions as F
from datetime import datetime, timedelta, timezone

import pytest

from conceptloom.operators.orphans import orphan_counts, orphan_references, orphan_relations

RELATION = "relation_id string, source_name string, target_name string, chapter_id string, extracted_at timestamp, kind string, at long"
CONCEPT = "concept_id string, name string, aliases array<string>, chapter_id string, created_at timestamp, deleted_at timestamp, key string"


def day(n):
    return datetime(2025, 1, 1, tzinfo=timezone.utc) + timedelta(days=n)


def found(spark, relations, concepts):
    r = spark.createDataFrame([(*x, "clash", 1) for x in relations], RELATION)
    c = spark.createDataFrame([(*x, "clash") for x in concepts], CONCEPT)
    return {(x.relation_id, x.side): x.kind for x in orphan_relations(r, c).collect()}


def test_kinds_by_time(spark):
    concepts = [
        ("c1", " A  name", None, "x", day(10), day(20)),
        ("c2", "other", ["a NAME", None, " ", ""], "x", day(15), day(30)),  # overlaps: one run from 10 to 30
        ("c3", "a name", [], "x", day(40), None),
        ("c4", "gone", None, "x", day(1), day(2)),
        ("c4", "gone", None, "x", day(1), day(2)),
        ("c5", None, None, "x", day(1), None),
    ]
    at = {"r5": 5, "r10": 10, "r25": 25, "r30": 30, "r40": 40, "r99": 99}
    relations = [(k, "A Name", "Gone ", "x", day(n)) for k, n in at.items()]
    relations += [("other", "a name", "\t", "y", day(50)), ("none", None, "", "x", day(50)), ("r5", "A Name", "Gone ", "x", day(5))]
    assert found(spark, relations, concepts) == {
        ("r5", "source"): "late", ("r30", "source"): "late", ("other", "source"): "missing",
        **{(k, "target"): "deleted" for k in at},
    }


def test_deleted_reference_is_open_at_its_end(spark):
    got = found(spark, [("a", "n", "n", "x", day(2)), ("b", "n", None, "x", day(1))], [("c", "n", None, "x", day(1), day(2))])
    assert got == {("a", "source"): "deleted", ("a", "target"): "deleted"}


def test_times_missing(spark):
    got = found(spark, [("a", "n", None, "x", None), ("b", "m", None, "x", day(3)), ("c", "n", None, None, day(3))], [("c", "n", None, "x", day(1), None), ("d", "m", None, "x", None, None)])
    assert got == {("a", "source"): "deleted", ("b", "source"): "deleted", ("c", "source"): "missing"}


def test_empty_tables(spark):
    assert found(spark, [], []) == {}
    assert found(spark, [("a", "n", "m", "x", day(1))], []) == {("a", "source"): "missing", ("a", "target"): "missing"}


def test_counts(spark):
    r = spark.createDataFrame([("a", "n", "m", "x", day(1), "", 0), ("b", "n", None, "x", day(40), "", 0)], RELATION)
    got = {(x.side, x.month, x.kind): x.n_orphans for x in orphan_counts(r, spark.createDataFrame([], CONCEPT)).collect()}
    assert got == {("source", "2025-01", "missing"): 1, ("target", "2025-01", "missing"): 1, ("source", "2025-02", "missing"): 1}


@pytest.mark.parametrize("seed", range(3))
def test_random_against_brute_force(spark, seed):
    import random

    r = random.Random(seed)
    lives = [(f"k{r.randrange(3)}", r.randrange(100), r.choice([None, r.randrange(120)])) for _ in range(25)]
    refs = [(i, f"k{r.randrange(4)}", r.randrange(-5, 130)) for i in range(200)]
    got = orphan_references(
        spark.createDataFrame(refs, "id long, key string, at long"), spark.createDataFrame(lives, "key string, created long, deleted long"), ["key"], "at", "created", "deleted"
    ).collect()
    want = {}
    for i, k, t in refs:
        own = [(c, d) for key, c, d in lives if key == k]
        if not any(c <= t and (d is None or d > t) for c, d in own):
            want[i] = "missing" if not own else "late" if any(c > t for c, _ in own) else "deleted"
    assert {x.id: x.kind for x in got} == want


def test_hot_key_is_spread_over_chunks(spark):
    """A key with lives in many chunks of time gives the same runs as a plain merge."""
    day_ = 86_400_000_000
    lives = [("hot", i * 7 * day_, i * 7 * day_ + (9 * day_ if i % 5 else day_)) for i in range(300)]
    refs = [(i, "hot", i * day_) for i in range(0, 2100, 3)]
    got = {x.id for x in orphan_references(spark.createDataFrame(refs, "id long, key string, at long"), spark.createDataFrame(lives, "key string, created long, deleted long"), ["key"], "at", "created", "deleted").collect()}
    assert got == {i for i, _, t in refs if not any(c <= t < d for _, c, d in lives)}


def test_a_name_with_many_lives_and_references(spark):
    """Both ways to the run before a reference give the same."""
    import random

    from conceptloom.operators.orphans import DAY, existence_runs, run_before

    r = random.Random(5)
    lives = [("hot", i * DAY, i * DAY + r.randrange(1, DAY)) for i in range(0, 300, 2)] + [("cold", 5, 9)]
    parents = spark.createDataFrame(lives, "key string, created long, deleted long")
    rows = [(i, r.choice(["hot", "hot", "hot", "cold", "none"]), r.randrange(-DAY, 310 * DAY)) for i in range(500)] + [(900, "hot", 0), (901, "hot", 2 * DAY), (902, "cold", 5)]
    refs = spark.createDataFrame(rows, "id int, key string, at long").withColumn("__at", F.col("at"))
    runs = existence_runs(parents, ["key"], "created", "deleted")
    seen = lambda few: sorted((x.id, str(x["__run_end"]), str(x["__last_created"])) for x in run_before(refs, runs, ["key"], few).collect())
    assert seen(8) == seen(10**6) and len(seen(8)) == len(rows)
