"""Topics: clusters of a chapter's concepts, with every concept in one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptloom.adapters import hashed_embedding
from conceptloom.operators.clusters import clustered
from conceptloom.operators.extract import topic_lines
from conceptloom.runtime import Scratch


def topic_clusters(vectors: DataFrame, scope: str, item: str, vector: str, least: int) -> DataFrame:
    """(scope, item, topic): density clusters in which noise goes to the first cluster of its scope; a scope of noise alone is
    one topic."""
    got = Scratch(vectors.sparkSession, "clusters").save(clustered(vectors, scope, item, vector, least), "all")
    first = got.groupBy(scope).agg(F.min(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("first"))
    return got.join(first, scope).select(scope, item, F.when(F.col("cluster") >= 0, F.col("cluster")).otherwise(F.coalesce("first", F.lit(0))).alias("topic"))


def topic_members(concepts: DataFrame, least: int, vectors: DataFrame | None = None, replies: DataFrame | None = None) -> DataFrame:
    """(chapter_id, domain, topic, title, concept_id): each concept (concept_id, chapter_id, domain, name, concept_seq) in a topic of
    its domain in its chapter, by density clusters of the names' vectors (concept_id, embedding; by default hashed words).

    A title is the one recorded for the topic (replies: key 'chapter/domain/topic', reply: a line of title | summary | concepts |
    difficulty), else the name of its first concept. Rows, not lists, so a giant topic needs no array.
    """
    scratch = Scratch(concepts.sparkSession, "topics")
    if vectors is None:
        vectors = concepts.select("concept_id", hashed_embedding(F.coalesce("name", F.lit(""))).alias("embedding"))
    scope = F.to_json(F.struct("chapter_id", "domain"))
    rows = scratch.save(concepts.select("concept_id", "chapter_id", "domain", "name", "concept_seq", scope.alias("scope")), "rows")
    got = topic_clusters(rows.select("scope", "concept_id").join(vectors.select("concept_id", "embedding"), "concept_id"), "scope", "concept_id", "embedding", least)
    met = scratch.save(rows.join(got.select("concept_id", F.col("topic").cast("string").alias("topic")), "concept_id"), "members")
    first = met.groupBy("scope", "topic").agg(F.min_by("name", F.struct("concept_seq", "concept_id")).alias("title"))
    if replies is not None:
        said = topic_lines(replies.filter("reply is not null"), "key", "reply").select("key", F.nullif("title", F.lit("")).alias("said"))
        keys = met.select("scope", "topic", F.concat_ws("/", "chapter_id", "domain", "topic").alias("key")).distinct()
        first = first.join(keys.join(said, "key"), ["scope", "topic"], "left").select("scope", "topic", F.coalesce("said", "title").alias("title"))
    return met.join(first, ["scope", "topic"]).select("chapter_id", "domain", "topic", "title", "concept_id")


def topic_difficulty(concepts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, difficulty, n): one more than the whole part of the average difficulty, between 1 and 5."""
    rows = concepts.groupBy(*keys).agg(F.avg("difficulty").alias("a"), F.count(F.lit(1)).alias("n"))
    return rows.select(*keys, F.greatest(F.lit(1), F.least(F.lit(5), F.col("a").cast("int") + 1)).cast("long").alias("difficulty"), "n")
