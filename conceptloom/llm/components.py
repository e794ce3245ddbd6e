"""Consolidating pairwise matches into groups by hash-to-min."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptloom.functions.text import id_form, name_form, present
from conceptloom.runtime import Scratch, fingerprint


def equal_value_links(df: DataFrame, item: str, keys: list[str]) -> DataFrame:
    """Link the items of equal keys, each to the smallest of them: (a, b). Null keys link nothing.

    A star instead of all pairs, so k equal items give k - 1 links; the smallest is found by a partial aggregation.
    """
    rows = df.dropna(subset=[item, *keys])
    smallest = rows.groupBy(*keys).agg(F.min(item).alias("b"), F.max(item).alias("__last")).filter(F.col("b") < F.col("__last")).drop("__last")
    return rows.join(smallest, keys).filter(F.col(item) != F.col("b")).select(F.col(item).alias("a"), "b")


def consolidate(links: DataFrame) -> DataFrame:
    """(concept_id, group_id) for every id on a link (a, b); group_id is the smallest id linked directly or indirectly.

    Hash-to-min: every vertex holds a cluster, at first itself and its neighbours. In each round it sends its cluster
    to the cluster's minimum and that minimum to every member; received clusters are united; the end is reached when
    nothing changes. Clusters are rows (v, u), never arrays, so a giant component is spread over tasks: the minimum is
    a partial aggregation, and the join with it splits a hot vertex (adaptive skew join). Vertices are 64-bit hashes of
    their ids while the loop runs; if two ids share a hash the hash is taken with another seed. Null ids, and links of
    an id with itself, are ignored; repeated and reversed links count once.
    """
    scratch = Scratch(links.sparkSession, "groups")
    links = scratch.save(links.filter(F.col("a") != F.col("b")).select("a", "b"), "links")
    for seed in range(42, 58):
        code = lambda c: F.xxhash64(F.lit(seed), c)  # noqa: E731, B023
        ids = links.select(F.explode(F.array("a", "b")).alias("id")).select(code("id").alias("h"), "id")
        names = scratch.save(ids.groupBy("h").agg(F.min("id").alias("id"), F.max("id").alias("other")), f"names{seed}")
        if not names.filter(F.col("id") != F.col("other")).head(1):
            break
    edges = links.select(code("a").alias("a"), code("b").alias("b"))
    ends = F.array(*[F.struct(F.col(v).alias("v"), F.col(u).alias("u")) for v, u in (("a", "a"), ("a", "b"), ("b", "a"), ("b", "b"))])
    clusters = scratch.save(edges.select(F.explode(ends).alias("e")).select("e.v", "e.u").distinct(), "round0")
    mark, k = fingerprint(clusters), 0
    while True:
        k += 1
        least = clusters.groupBy("v").agg(F.min("u").alias("m"))
        sent = clusters.join(least, "v").select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
        following = scratch.save(sent.select("e.v", "e.u").distinct(), f"round{k}")
        scratch.drop(f"round{k - 1}")
        before, mark, clusters = mark, fingerprint(following), following
        if mark == before:
            break
    member = clusters.groupBy("v").agg(F.min("u").alias("root"))
    known = scratch.save(member.join(names, F.col("v") == F.col("h")).select("root", F.col("id").alias("concept_id")), "members")
    group = known.groupBy("root").agg(F.min("concept_id").alias("group_id"))
    return known.join(group, "root").select("concept_id", "group_id")


def concept_links(remap: DataFrame, concepts: DataFrame) -> DataFrame:
    """Links (a, b) between concept ids in compared form: matches of the remap, and equal names in a chapter."""
    matched = remap.select(id_form("old_id").alias("a"), id_form("canonical_id").alias("b")).filter(present(F.col("a")) & present(F.col("b")) & (F.col("a") != F.col("b")))
    named = concepts.select(id_form("concept_id").alias("id"), "chapter_id", name_form("name").alias("name")).filter(present(F.col("id")) & present(F.col("name")))
    return matched.unionByName(equal_value_links(named, "id", ["chapter_id", "name"]))


def concept_groups(remap: DataFrame, concepts: DataFrame) -> DataFrame:
    """(concept_id, group_id) for every concept on a link, those that only the remap knows included."""
    return consolidate(concept_links(remap, concepts))
