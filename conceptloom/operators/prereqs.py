"""Prerequisite graphs: edges, cycles, depths, learning order and temporal edges."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conceptloom.adapters import hashed_embedding
from conceptloom.config import DEFAULTS, EngineConfig
from conceptloom.functions.text import relation_form
from conceptloom.operators.pairs import similar_pairs
from conceptloom.operators.resolve import resolved_relations
from conceptloom.runtime import Scratch


def is_prerequisite():
    return F.coalesce(F.col("is_prereq"), F.lit(False)) | F.coalesce(F.col("relation") == "requires", F.lit(False))


def plain_relations(relations: DataFrame) -> DataFrame:
    """Relations with their kind as the parsers write it: lower case, stripped, blanks inside as underscores."""
    return relations.withColumn("relation", relation_form("relation"))


def prerequisite_edges(relations: DataFrame, canonical: DataFrame, last: bool = False) -> DataFrame:
    """(chapter_id, source, target, confidence): resolved prerequisite relations, self loops removed, the best confidence of each
    edge (at least 0; NaN and null count as 0)."""
    rows = resolved_relations(relations.filter(is_prerequisite()), canonical, last).filter(F.col("source") != F.col("target"))
    sure = F.coalesce(F.nanvl("confidence", F.lit(None)), F.lit(0.0))
    return rows.groupBy("chapter_id", "source", "target").agg(F.greatest(F.lit(0.0), F.max(sure)).alias("confidence"))


#: Edges of a scope that one task may hold; larger scopes are worked off in rounds over all tasks, with the same result.
SCOPE_EDGES = 200_000


def _by_size(edges: DataFrame, scope: str, most: int) -> tuple[DataFrame, DataFrame, bool]:
    """Edges of small scopes, edges of large ones, and whether there are any of the latter."""
    n = edges.groupBy(scope).agg(F.count(F.lit(1)).alias("__n"))
    sized = edges.join(n, scope)
    large = sized.filter(F.col("__n") > most).drop("__n")
    return sized.filter(F.col("__n") <= most).drop("__n"), large, bool(n.filter(F.col("__n") > most).head(1))


def _peeled(edges: DataFrame, scope: str) -> DataFrame:
    """What is left when edges at nodes that nothing reaches, or that reach nothing, are taken away again and again."""
    scratch = Scratch(edges.sparkSession, "cycles")
    core, k, n = scratch.save(edges, "c0"), 0, -1
    while (now := core.count()) != n and now:
        n, k = now, k + 1
        starts = core.select(scope, F.col("target").alias("source")).distinct()
        ends = core.select(scope, F.col("source").alias("target")).distinct()
        following = scratch.save(core.join(starts, [scope, "source"], "left_semi").join(ends, [scope, "target"], "left_semi").select(*edges.columns), f"c{k}")
        scratch.drop(f"c{k - 1}")
        core = following
    return core


def break_cycles(edges: DataFrame, scope: str = "chapter_id", most: int = SCOPE_EDGES) -> DataFrame:
    """Edges (scope, source, target, confidence) without cycles: of every cycle found the weakest edge goes (on ties the smallest).

    Scopes are searched depth first, always from the smallest node. Of a scope with more than ``most`` edges first all that
    can't be on a cycle is peeled off in rounds, which leaves its cyclic cores; edges on no cycle never matter, so the
    result is the same. Null ends are not allowed.
    """
    edges = Scratch(edges.sparkSession, "edges").save(edges.select(scope, "source", "target", "confidence"), "all")
    small, large, any_large = _by_size(edges, scope, most)
    kind = dict(edges.dtypes)

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        gone = weakest_cuts({(s, t): c for s, t, c in zip(rows["source"], rows["target"], rows["confidence"])})
        return pd.DataFrame([(rows[scope].iloc[0], s, t) for s, t in gone], columns=[scope, "source", "target"])

    cyclic = small.unionByName(_peeled(large, scope)) if any_large else small
    removed = cyclic.groupBy(scope).applyInPandas(cut, f"{scope} {kind[scope]}, source {kind['source']}, target {kind['target']}")
    return edges.join(removed, [scope, "source", "target"], "left_anti")


def weakest_cuts(weight: dict) -> list:
    """Edges to remove until no cycle is left: cycles are found depth first, and each loses its weakest edge."""
    following: dict = {}
    for s, t in sorted(weight):
        following.setdefault(s, []).append(t)
    gone: list = []
    dead: set = set()
    done: set = set()
    for start in sorted(following):
        while start not in done:
            path, on, stack, found = [], {}, [(start, iter(following.get(start, ())))], None
            on[start] = 0
            path.append(start)
            while stack:
                node, it = stack[-1]
                nxt = next((t for t in it if (node, t) not in dead and t not in done), None)
                if nxt is None:
                    stack.pop()
                    path.pop()
                    del on[node]
                    done.add(node)
                elif nxt in on:
                    cycle = path[on[nxt] :] + [nxt]
                    found = min(zip(cycle, cycle[1:]), key=lambda e: (weight[e], e))
                    break
                else:
                    on[nxt] = len(path)
                    path.append(nxt)
                    stack.append((nxt, iter(following.get(nxt, ()))))
            if found:
                dead.add(found)
                gone.append(found)
    return gone


def layer_numbers(pairs: list[tuple]) -> dict:
    """Longest-path depth of each node of (source, target) pairs by layers; -1 on or behind cycles."""
    following: dict = {}
    waits: dict = {}
    for s, t in set(pairs):
        following.setdefault(s, []).append(t)
        waits[t] = waits.get(t, 0) + 1
        waits.setdefault(s, 0)
    depth = dict.fromkeys(waits, -1)
    layer, k = [x for x, n in waits.items() if not n], 0
    while layer:
        nxt = []
        for x in layer:
            depth[x] = k
            for t in following.get(x, ()):
                waits[t] -= 1
                if not waits[t]:
                    nxt.append(t)
        layer, k = nxt, k + 1
    return depth


def depths(edges: DataFrame, scope: str = "chapter_id", source: str = "source", target: str = "target", most: int = SCOPE_EDGES) -> DataFrame:
    """(scope, node, depth): length of the longest path that ends at each node of an acyclic graph.

    Layers are peeled off: the nodes without predecessors leave, with the number of the round. Nodes on or behind a cycle
    never leave and have depth -1. A scope of up to ``most`` edges is one task's work; larger ones take part in rounds
    over all tasks, each of which lowers the counts of open predecessors.
    """
    scratch = Scratch(edges.sparkSession, "depths")
    pairs = scratch.save(edges.select(scope, F.col(source).alias("s"), F.col(target).alias("t")).distinct(), "pairs")
    small, large, any_large = _by_size(pairs, scope, most)
    kind = dict(pairs.dtypes)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        got = layer_numbers(list(zip(rows["s"], rows["t"])))
        return pd.DataFrame({scope: rows[scope].iloc[0], "node": list(got), "depth": pd.array(list(got.values()), dtype="int32")})

    out = small.groupBy(scope).applyInPandas(of, f"{scope} {kind[scope]}, node {kind['s']}, depth int")
    if not any_large:
        return out
    waits = large.groupBy(scope, F.col("t").alias("node")).agg(F.count(F.lit(1)).alias("waits"))
    nodes = large.select(scope, F.explode(F.array("s", "t")).alias("node")).distinct()
    start = F.coalesce("waits", F.lit(0))
    state, k = scratch.save(nodes.join(waits, [scope, "node"], "left").select(scope, "node", start.alias("waits"), F.when(start == 0, 0).otherwise(-1).alias("depth")), "n0"), 0
    while state.filter(F.col("depth") == k).head(1):
        free = state.filter(F.col("depth") == k).select(scope, F.col("node").alias("s"))
        less = large.join(free, [scope, "s"]).groupBy(scope, F.col("t").alias("node")).agg(F.count(F.lit(1)).alias("less"))
        rest = F.col("waits") - F.coalesce("less", F.lit(0))
        k += 1
        following = scratch.save(state.join(less, [scope, "node"], "left").select(scope, "node", rest.alias("waits"), F.when((F.col("depth") < 0) & (rest == 0), k).otherwise(F.col("depth")).alias("depth")), f"n{k}")
        scratch.drop(f"n{k - 1}")
        state = following
    return out.unionByName(state.select(scope, "node", F.col("depth").cast("int").alias("depth")))


def temporal_edges(vectors: DataFrame, scope: str, seq: str, item: str, vector: str, threshold: float, most: int, existing: DataFrame | None = None, last: str | None = None) -> DataFrame:
    """(scope, source, target, confidence): an item that is in a later segment depends on similar ones of an earlier segment of the
    scope, confidence 0.7 * similarity, the best ``most`` of each scope; existing edges are left out.

    seq is an item's first segment and ``last`` its last one, by default the same; items seen in several segments can depend
    on each other both ways.
    """
    pairs = similar_pairs(vectors, scope, item, vector, threshold)
    of = lambda x: vectors.select(F.col(scope), F.col(item).alias(f"seq_{x}"), F.col(seq).alias(f"q_{x}"), F.col(last or seq).alias(f"l_{x}"))
    met = pairs.join(of("a"), [scope, "seq_a"]).join(of("b"), [scope, "seq_b"])
    edge = lambda x, y: F.when(F.col(f"q_{y}") < F.col(f"l_{x}"), F.struct(F.col(f"seq_{x}").alias("source"), F.col(f"seq_{y}").alias("target")))
    met = met.select(scope, "similarity", F.explode(F.array(edge("a", "b"), edge("b", "a"))).alias("e")).filter(F.col("e").isNotNull()).select(scope, "e.source", "e.target", "similarity")
    if existing is not None:
        met = met.join(existing.select(scope, "source", "target"), [scope, "source", "target"], "left_anti")
    rank = F.row_number().over(Window.partitionBy(scope).orderBy(F.desc(F.round("similarity", 9)), "source", "target"))
    return met.withColumn("r", rank).filter(F.col("r") <= most).select(scope, "source", "target", (F.lit(0.7) * F.col("similarity")).alias("confidence"))


def concept_vectors(canonical: DataFrame, segments: DataFrame) -> DataFrame:
    """(chapter_id, concept_id, first, last, embedding): the default embedder's vectors of the names, with the first and last index
    of the segments that a concept was seen in; concepts without any are left out."""
    index = segments.groupBy("segment_id").agg(F.min("segment_index").alias("i"))
    one = canonical.dropDuplicates(["concept_id"])
    seen = one.select("concept_id", F.explode(F.array_distinct("source_segments")).alias("segment_id")).join(index, "segment_id").groupBy("concept_id").agg(F.min("i").alias("first"), F.max("i").alias("last"))
    return one.join(seen, "concept_id").select("chapter_id", "concept_id", "first", "last", hashed_embedding(F.coalesce("name", F.lit(""))).alias("embedding"))


def whole_dag(relations: DataFrame, canonical: DataFrame, segments: DataFrame, config: EngineConfig = DEFAULTS) -> DataFrame:
    """(chapter_id, source, target, confidence): prerequisites without cycles, with the temporal edges of each chapter that they
    don't have yet, and again without cycles."""
    scratch = Scratch(relations.sparkSession, "dag")
    dag = scratch.save(break_cycles(prerequisite_edges(plain_relations(relations), canonical)), "dag")
    vectors = scratch.save(concept_vectors(canonical, segments), "vectors")
    later = temporal_edges(vectors, "chapter_id", "first", "concept_id", "embedding", config.temporal_similarity, config.temporal_cap, dag, "last")
    return break_cycles(dag.unionByName(later.select(dag.columns)))


def acyclic(edges: DataFrame, scope: str = "chapter_id") -> DataFrame:
    """(scope, acyclic) of every scope that has edges."""
    return depths(edges, scope).groupBy(scope).agg(F.bool_and(F.col("depth") >= 0).alias("acyclic"))
