"""Entity resolution: fuzzy name pairs, leader groups, canonical concepts, and names resolved to ids."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptloom.config import DEFAULTS, EngineConfig
from conceptloom.adapters import decided, hashed_embedding
from conceptloom.functions.text import name_form, normal_name, present
from conceptloom.operators.clusters import clustered, triage
from conceptloom.operators.pairs import blocked, least_similarity, tiles, two_blocks
from conceptloom.runtime import Scratch


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (len(a) + len(b)), by bit-parallel longest common subsequence; two empty strings are equal."""
    if not a and not b:
        return 100.0
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | (1 << i)
    mask, s = (1 << len(a)) - 1, (1 << len(a)) - 1
    for ch in b:
        u = s & at.get(ch, 0)
        s = ((s + u) | (s - u)) & mask
    return 200.0 * (len(a) - s.bit_count()) / (len(a) + len(b))


#: Buckets into which the grams of names are counted.
BUCKETS = 512


def gram_counts(names: list[str], grams: int) -> np.ndarray:
    """Counts of each name's grams in hashed buckets. The product of two rows is at least the number of grams that the names
    share, repeated ones included."""
    out = np.zeros((len(names), BUCKETS), dtype=np.float32)
    for i, s in enumerate(names):
        for k in range(len(s) - grams + 1):
            out[i, zlib.crc32(s[k : k + grams].encode("utf-8", "surrogatepass")) % BUCKETS] += 1
    return out


def fuzzy_pairs(names: DataFrame, scope: str, seq: str, name: str, threshold: float, grams: int = 2, block: int = 2_000) -> DataFrame:
    """(scope, seq_a, seq_b, ratio) of names in one scope whose indel ratio reaches the threshold, seq_a < seq_b.

    Names must be distinct per scope. At ratio T two names differ in at most d = (1 - T/100) * (len a + len b) single
    insertions and deletions. Each changes at most ``grams`` grams, so they share at least max(grams a, grams b) - d * grams
    of them, and their lengths lie in a band. Names of near bands of length meet block by block; a product of gram counts
    bounds what a pair shares from above, and the ratio is taken only where the bound allows it. No pair is lost, and only
    pairs that reach the threshold leave a task. Null names are left out, empty ones are equal.
    """
    low = threshold / (200.0 - threshold)
    rows = names.select(scope, F.col(seq).alias("seq"), F.col(name).alias("__s")).dropna(subset=["__s"])
    by_length = F.when(F.char_length("__s") == 0, F.lit(-9)).otherwise(F.floor(F.log(F.char_length("__s").cast("double")) / F.lit(-math.log(min(low, 0.99)) + 1e-9))).cast("long")
    size = rows.groupBy(scope).agg(F.count(F.lit(1)).alias("__n"))  # a scope of one block needs no bands
    rows = rows.join(size, scope).withColumn("cell", F.when(F.col("__n") <= block, F.lit(0).cast("long")).otherwise(by_length)).drop("__n")
    kind = dict(names.dtypes)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, same = two_blocks(rows, "seq")
        sa, sb, qa, qb = a["__s"].tolist(), b["__s"].tolist(), a["seq"].to_numpy(), b["seq"].to_numpy()
        la, lb = (np.array([len(x) for x in y], dtype=np.float32) for y in (sa, sb))
        out, kept = [], {}

        def counts(side: str, names: list[str], at: slice) -> np.ndarray:
            if kept.get(side, (None,))[0] != at.start:
                kept[side] = at.start, gram_counts(names[at], grams)
            return kept[side][1]

        for p, q in tiles(len(sa), len(sb), same):
            most = np.floor((1.0 - threshold / 100.0) * (la[p, None] + lb[None, q]) + 1e-4)
            need = np.maximum(np.maximum(la[p, None], lb[None, q]) - grams + 1, 0) - most * grams
            may = np.abs(la[p, None] - lb[None, q]) <= most
            if not may.any():
                continue
            may &= counts("a", sa, p) @ counts("b", sb, q).T >= need
            if same and p == q:
                may = np.triu(may, 1)
            for i, j in zip(*np.nonzero(may)):
                i, j = i + p.start, j + q.start
                ratio = indel_ratio(sa[i], sb[j])
                if ratio >= threshold:
                    out.append((min(qa[i], qb[j]), max(qa[i], qb[j]), ratio))
        got = pd.DataFrame(out, columns=["seq_a", "seq_b", "ratio"])
        got.insert(0, scope, rows[scope].iloc[0])
        return got

    return blocked(rows, scope, "seq", (-1, 0, 1), block).groupBy(scope, "__x", "__y").applyInPandas(of, f"{scope} {kind[scope]}, seq_a {kind[seq]}, seq_b {kind[seq]}, ratio double")


def leaders(pairs: DataFrame, items: DataFrame, scope: str, seq: str) -> DataFrame:
    """(scope, seq, leader): greedy leader clustering of items in the order of seq, given all similar pairs.

    Item j leads if no earlier leader is similar to it, else it joins its first similar leader: the lexicographically first
    maximal independent set. In each round every undecided item whose earlier similar items are all decided followers
    leads, and what is similar to a leader follows; the rounds end when all are decided.
    """
    scratch = Scratch(items.sparkSession, "leaders")
    pairs = scratch.save(pairs.select(scope, "seq_a", "seq_b"), "pairs")
    state = scratch.save(items.select(scope, F.col(seq).alias("seq"), F.lit(None).cast("boolean").alias("leads")), "s0")
    k = 0
    while state.filter(F.col("leads").isNull()).head(1):
        k += 1
        of = lambda x: state.select(scope, F.col("seq").alias(f"seq_{x}"), F.col("leads").alias(f"leads_{x}"))  # noqa: E731, B023
        # An undecided item waits while an earlier similar one is undecided, and follows if an earlier one leads.
        seen = pairs.join(of("a"), [scope, "seq_a"]).groupBy(scope, F.col("seq_b").alias("seq")).agg(F.bool_or(F.col("leads_a").isNull()).alias("waits"), F.bool_or(F.coalesce("leads_a", F.lit(False))).alias("follows"))
        step = state.join(seen, [scope, "seq"], "left")
        decided = F.when(F.col("leads").isNotNull(), F.col("leads")).when(F.coalesce("follows", F.lit(False)), False).when(F.coalesce("waits", F.lit(False)), None).otherwise(True)
        following = scratch.save(step.select(scope, "seq", decided.alias("leads")), f"s{k}")
        scratch.drop(f"s{k - 1}")
        state = following
    lead = state.filter("leads").select(scope, F.col("seq").alias("seq_a"))
    first = pairs.join(lead, [scope, "seq_a"]).groupBy(scope, F.col("seq_b").alias("seq")).agg(F.min("seq_a").alias("leader"))
    joined = state.join(first, [scope, "seq"], "left")
    return joined.select(scope, "seq", F.when(F.col("leads"), F.col("seq")).otherwise(F.col("leader")).alias("leader"))


def lexical_groups(concepts: DataFrame, config: EngineConfig = DEFAULTS) -> DataFrame:
    """(concept_id, leader_seq): concepts grouped by fuzzy names within their chapter, first concept first.

    Equal normalised names are one item, at the place of the earliest of them.
    """
    rows = concepts.dropDuplicates(["concept_id"]).select("concept_id", "chapter_id", "concept_seq", normal_name("name", ascii_only=False).alias("norm"))
    items = Scratch(concepts.sparkSession, "names").save(rows.groupBy("chapter_id", "norm").agg(F.min("concept_seq").alias("seq")), "items")
    pairs = fuzzy_pairs(items, "chapter_id", "seq", "norm", config.lexical_ratio)
    led = leaders(pairs, items, "chapter_id", "seq")
    return rows.join(items, ["chapter_id", "norm"]).join(led, ["chapter_id", "seq"]).select("concept_id", F.col("leader").alias("leader_seq"))


def exact_groups(concepts: DataFrame) -> DataFrame:
    """(chapter_id, form, first_seq, n): concepts with equal compared names."""
    rows = concepts.dropDuplicates(["concept_id"]).withColumn("form", name_form("name"))
    return rows.groupBy("chapter_id", "form").agg(F.min("concept_seq").alias("first_seq"), F.count(F.lit(1)).alias("n"))


def score_of(confidence: Column, frequency: Column, most: Column, config: EngineConfig = DEFAULTS) -> Column:
    return config.base_weight * F.coalesce(F.nanvl(confidence, F.lit(None)), F.lit(0.0)) + config.frequency_weight * F.coalesce(frequency, F.lit(1)) / F.greatest(most, F.lit(1))


def mode_names(concepts: DataFrame, groups: DataFrame) -> DataFrame:
    """(chapter_id, group, name, n): the commonest name of each group, on ties the one seen first."""
    rows = concepts.dropDuplicates(["concept_id"]).select("concept_id", "chapter_id", "concept_seq", "name").join(groups, "concept_id")
    named = rows.groupBy("chapter_id", "group", "name").agg(F.count(F.lit(1)).alias("n"), F.min("concept_seq").alias("seq"))
    best = named.groupBy("chapter_id", "group").agg(F.min(F.struct((-F.col("n")).alias("m"), "seq", "name")).alias("b"))
    return best.select("chapter_id", "group", "b.name", (-F.col("b.m")).alias("n"))


def equal_name_groups(concepts: DataFrame) -> DataFrame:
    """(concept_id, group): concepts with equal compared names in a chapter; a null name is a group of its own kind."""
    return concepts.dropDuplicates(["concept_id"]).select("concept_id", name_form("name").alias("group"))


def canonical_concepts(concepts: DataFrame, groups: DataFrame | None = None, config: EngineConfig = DEFAULTS) -> DataFrame:
    """One canonical concept for each group (concept_id, group) of a chapter, by default those of equal names: (chapter_id, group,
    concept_id, name, type, definition, domain, segment_id, source_type, frequency, confidence, aliases, source_segments,
    difficulty).

    The winner has the best score, on ties the first; frequency is the group's sum, confidence the winner's with that sum, at
    most 1; aliases are the other names and source_segments the segments, different ones in the order first seen. Names and
    segments are made different by partial aggregation before they are listed, so a list is as large as its value.
    """
    groups = equal_name_groups(concepts) if groups is None else groups
    rows = concepts.dropDuplicates(["concept_id"]).withColumn("f", F.coalesce("frequency", F.lit(1))).join(groups.select("concept_id", "group"), "concept_id")
    most = rows.groupBy("chapter_id").agg(F.max("f").alias("most"))
    keys = ["chapter_id", "group"]
    scored = rows.join(most, "chapter_id").withColumn("score", score_of(F.col("confidence"), F.col("f"), F.col("most"), config))
    fields = ("concept_id", "name", "type", "definition", "domain", "segment_id", "source_type", "confidence")
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("concept_seq").alias("q"), *fields))
    grouped = scored.groupBy(*keys).agg(best.alias("b"), F.sum("f").alias("frequency"), F.max("most").alias("most"))

    def listed(column: str, name: str) -> DataFrame:
        different = rows.filter(F.coalesce(column, F.lit("")) != "").groupBy(*keys, column).agg(F.min("concept_seq").alias("q"))
        got = different.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("q", F.col(column).alias("x")))).alias("l"))
        return got.select(*[F.col(k).alias(f"__{name}_{k}") for k in keys], F.transform("l", lambda v: v.x).alias(name))

    out = grouped
    for column, name in (("name", "names"), ("segment_id", "segments")):
        out = out.join(listed(column, name), F.expr(" AND ".join(f"{k} <=> __{name}_{k}" for k in keys)), "left")
    none = F.array().cast("array<string>")
    sure = F.least(F.lit(1.0), score_of(F.col("b.confidence"), F.col("frequency"), F.col("most"), config))
    return out.select(
        *keys, *[F.col(f"b.{f}").alias(f) for f in fields[:-1]], "frequency", sure.alias("confidence"),
        F.coalesce(F.filter("names", lambda x: ~x.eqNullSafe(F.col("b.name"))), none).alias("aliases"), F.coalesce("segments", none).alias("source_segments"), F.lit(1).alias("difficulty"),
    )


def id_remap(concepts: DataFrame, groups: DataFrame | None = None, config: EngineConfig = DEFAULTS) -> DataFrame:
    """(old_id, canonical_id) of every concept that isn't its own canonical concept, in groups as of ``canonical_concepts``."""
    groups = equal_name_groups(concepts) if groups is None else groups
    rows = concepts.dropDuplicates(["concept_id"]).withColumn("f", F.coalesce("frequency", F.lit(1))).select("concept_id", "chapter_id", "concept_seq", "confidence", "f").join(groups.select("concept_id", "group"), "concept_id")
    most = rows.groupBy("chapter_id").agg(F.max("f").alias("most"))
    scored = rows.join(most, "chapter_id").withColumn("score", score_of(F.col("confidence"), F.col("f"), F.col("most"), config))
    best = scored.groupBy("chapter_id", "group").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("concept_seq").alias("q"), F.col("concept_id").alias("id"))).alias("b"))
    won = best.select(F.col("chapter_id").alias("__c"), F.col("group").alias("__g"), F.col("b.id").alias("canonical_id"))
    met = rows.join(won, F.col("chapter_id").eqNullSafe(F.col("__c")) & F.col("group").eqNullSafe(F.col("__g")))
    return met.filter(F.col("concept_id") != F.col("canonical_id")).select(F.col("concept_id").alias("old_id"), "canonical_id")


def semantic_clusters(concepts: DataFrame, lexical: DataFrame, config: EngineConfig = DEFAULTS, vectors: DataFrame | None = None) -> DataFrame:
    """(chapter_id, group, cluster, n, least, fate): lexical groups (concept_id, group) in density clusters of their commonest
    names' vectors, with the cluster's smallest similarity and what becomes of it: merge, check or split; noise (cluster -1)
    and clusters of one are split, that is, stay as they are.

    Vectors are (chapter_id, group, embedding), by default hashed words of the commonest name.
    """
    scratch = Scratch(concepts.sparkSession, "semantic")
    if vectors is None:
        vectors = mode_names(concepts, lexical).select("chapter_id", "group", hashed_embedding(F.coalesce("name", F.lit(""))).alias("embedding"))
    vectors = scratch.save(vectors.select("chapter_id", "group", "embedding"), "vectors")
    got = scratch.save(clustered(vectors, "chapter_id", "group", "embedding", config.min_cluster), "clusters")
    own = F.concat_ws("/", "chapter_id", F.col("cluster").cast("string"))
    members = got.filter("cluster >= 0").withColumn("key", own)
    low = least_similarity(members.join(vectors, ["chapter_id", "group"]).select("key", "group", "embedding"), "key", "group", "embedding")
    fate = F.when(F.coalesce("n", F.lit(1)) < 2, "split").otherwise(triage(F.col("least"), config.merge_similarity, config.check_similarity))
    return got.withColumn("key", own).join(low, "key", "left").select("chapter_id", "group", "cluster", F.coalesce("n", F.lit(1)).alias("n"), "least", fate.alias("fate"))


def resolved_groups(concepts: DataFrame, replies: DataFrame | None = None, config: EngineConfig = DEFAULTS, vectors: DataFrame | None = None) -> DataFrame:
    """(concept_id, group): fuzzy name groups, merged by density clusters after triage.

    Clusters that merge become one group; those to be checked do if the decider said yes (replies: key 'chapter/cluster',
    reply), else their concepts are groups of their own; the rest stay the lexical groups that they were. A group is named
    by its first concept's place, so groups of the three kinds never share a name.
    """
    scratch = Scratch(concepts.sparkSession, "resolved")
    lexical = scratch.save(lexical_groups(concepts, config).select("concept_id", F.col("leader_seq").alias("group")), "lexical")
    clusters = scratch.save(semantic_clusters(concepts, lexical, config, vectors), "clusters").withColumn("key", F.concat_ws("/", "chapter_id", F.col("cluster").cast("string")))
    if replies is None:
        replies = concepts.sparkSession.createDataFrame([], "key string, reply string")
    said = decided(clusters.filter("fate = 'check'"), replies, "key").withColumnRenamed("merge", "yes")
    joined = F.min("group").over(Window.partitionBy("key"))
    whole = clusters.join(said, "key", "left").filter((F.col("fate") == "merge") | F.col("yes")).withColumn("into", joined).select("chapter_id", "group", "into")
    apart = clusters.join(said, "key", "left").filter((F.col("fate") == "check") & ~F.coalesce("yes", F.lit(False))).select("chapter_id", "group", F.lit(True).alias("apart"))
    rows = concepts.dropDuplicates(["concept_id"]).select("concept_id", "chapter_id", "concept_seq").join(lexical, "concept_id")
    rows = rows.join(whole, ["chapter_id", "group"], "left").join(apart, ["chapter_id", "group"], "left")
    return rows.select("concept_id", F.when(F.col("apart"), F.col("concept_seq")).otherwise(F.coalesce("into", "group")).alias("group"))


def decider_names(concepts: DataFrame, clusters: DataFrame, lexical: DataFrame, most: int = 8) -> DataFrame:
    """(key, names): what a decider is asked about: the first different names of each cluster to be checked, quoted."""
    rows = concepts.dropDuplicates(["concept_id"]).select("concept_id", "chapter_id", "concept_seq", "name").join(lexical, "concept_id").join(clusters.filter("fate = 'check'").select("chapter_id", "group", "cluster"), ["chapter_id", "group"])
    named = rows.groupBy("chapter_id", "cluster", "name").agg(F.min("concept_seq").alias("q"))
    first = named.withColumn("r", F.row_number().over(Window.partitionBy("chapter_id", "cluster").orderBy("q"))).filter(F.col("r") <= most)
    listed = first.groupBy("chapter_id", "cluster").agg(F.array_sort(F.collect_list(F.struct("r", "name"))).alias("l"))
    return listed.select(F.concat_ws("/", "chapter_id", F.col("cluster").cast("string")).alias("key"), F.array_join(F.transform("l", lambda x: F.concat(F.lit('"'), F.coalesce(x["name"], F.lit("")), F.lit('"'))), ", ").alias("names"))


def name_index(canonical: DataFrame, last: bool = False) -> DataFrame:
    """(chapter_id, key, id): each name and alias with the first, or last, concept that bears it in the chapter."""
    names = F.concat(F.array("name"), F.coalesce(F.col("aliases"), F.array().cast("array<string>")))
    rows = canonical.dropDuplicates(["concept_id"]).select("chapter_id", "concept_id", "concept_seq", F.posexplode(names).alias("place", "name")).withColumn("key", name_form("name")).filter(present(F.col("key")))
    order = F.struct("concept_seq", "place", "concept_id")
    pick = F.max_by if last else F.min_by
    return rows.groupBy("chapter_id", "key").agg(pick("concept_id", order).alias("id"))


def resolved_relations(relations: DataFrame, canonical: DataFrame, last: bool = False) -> DataFrame:
    """Relations, one per relation_id, with both names resolved to ids of their chapter; others are dropped."""
    index = name_index(canonical, last)
    rows = relations.dropDuplicates(["relation_id"]).withColumns({"__s": name_form("source_name"), "__t": name_form("target_name")})
    for side, key in (("source", "__s"), ("target", "__t")):
        rows = rows.join(index.select("chapter_id", F.col("key").alias(key), F.col("id").alias(side)), ["chapter_id", key])
    return rows.drop("__s", "__t")


def remapped(df: DataFrame, column: str, remap: DataFrame) -> DataFrame:
    """df with the ids of a column replaced by their canonical ids (old_id, canonical_id; the smallest of several); others stay."""
    one = remap.dropna().groupBy(F.col("old_id").alias(column)).agg(F.min("canonical_id").alias("__new"))
    return df.join(one, column, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")
