"""Queries and SQL of the general data operators (problems 4 and 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptloom.operators.hierarchy import descendants, prerequisite_links, resolve_trees
from conceptloom.operators.orphans import orphan_counts, orphan_relations
from conceptloom.runtime import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return orphan_relations(table(spark, d, "stage6_raw_relations"), table(spark, d, "stage7_canonical_concepts")).select("relation_id", "side", "kind")


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    return orphan_counts(table(spark, d, "stage6_raw_relations"), table(spark, d, "stage7_canonical_concepts"))


def _links(spark: SparkSession, d: str) -> DataFrame:
    return prerequisite_links(table(spark, d, "stage6_raw_relations"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return resolve_trees(_links(spark, d))


def p6_paths(spark: SparkSession, d: str) -> DataFrame:
    return resolve_trees(_links(spark, d), with_path=True).select("chapter_id", "node", "root", "depth", "path")


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    return descendants(_links(spark, d)).select("chapter_id", "ancestor", "descendant", "distance")


QUERIES = {f.__name__: f for f in (p4_found, p4_counts, p6_found, p6_paths, p6_descendants)}


def sql_name(c: str) -> str:
    """The compared form of a name in SQL."""
    return f"lower(trim(regexp_replace({c}, '[ \\t\\x{{00A0}}]+', ' ', 'g')))"


_CASES = f"""
WITH refs AS (
  SELECT relation_id, 'source' AS side, chapter_id, {sql_name("source_name")} AS k, extracted_at AS t FROM stage6_raw_relations
  UNION
  SELECT relation_id, 'target', chapter_id, {sql_name("target_name")}, extracted_at FROM stage6_raw_relations
), parents AS (
  SELECT DISTINCT chapter_id, {sql_name("n")} AS k, created_at, deleted_at
  FROM (SELECT chapter_id, created_at, deleted_at, unnest(list_concat([name], coalesce(aliases, []))) AS n FROM stage7_canonical_concepts)
), judged AS (
  SELECT r.relation_id, r.side, r.t, count(p.k) AS n,
    coalesce(bool_or(p.created_at <= r.t AND (p.deleted_at IS NULL OR p.deleted_at > r.t)), false) AS alive,
    coalesce(bool_or(p.created_at > r.t), false) AS later
  FROM refs r LEFT JOIN parents p ON p.chapter_id = r.chapter_id AND p.k = r.k
  WHERE r.k <> '' GROUP BY 1, 2, 3
), cases AS (
  SELECT DISTINCT relation_id, side, CASE WHEN n = 0 THEN 'missing' WHEN later THEN 'late' ELSE 'deleted' END AS kind, strftime(t AT TIME ZONE 'UTC', '%Y-%m') AS month
  FROM judged WHERE NOT alive
)
"""
_TREE = f"""
WITH RECURSIVE links AS (
  SELECT DISTINCT chapter_id, {sql_name("source_name")} AS child, {sql_name("target_name")} AS parent FROM stage6_raw_relations
  WHERE (coalesce(is_prereq, false) OR {sql_name("relation")} = 'requires') AND {sql_name("source_name")} <> '' AND {sql_name("target_name")} <> ''
), tree AS (
  SELECT DISTINCT chapter_id, parent AS node, parent AS root, CAST(0 AS BIGINT) AS depth, parent AS path FROM links l
  WHERE NOT EXISTS (SELECT 1 FROM links u WHERE u.chapter_id = l.chapter_id AND u.child = l.parent)
  UNION ALL
  SELECT l.chapter_id, l.child, t.root, t.depth + 1, t.path || ' > ' || l.child FROM links l JOIN tree t ON l.chapter_id = t.chapter_id AND l.parent = t.node
), names AS (SELECT chapter_id, child AS node FROM links UNION SELECT chapter_id, parent FROM links)
"""
SQL = {
    "p4_found": _CASES + "SELECT relation_id, side, kind FROM cases",
    "p4_counts": _CASES + "SELECT side, month, kind, CAST(count(*) AS BIGINT) AS n_orphans FROM cases GROUP BY 1, 2, 3",
    "p6_found": _TREE + "SELECT n.chapter_id, n.node, coalesce(t.root, '') AS root, coalesce(t.depth, -1) AS depth FROM names n LEFT JOIN tree t ON n.chapter_id = t.chapter_id AND n.node = t.node",
    "p6_paths": _TREE + "SELECT n.chapter_id, n.node, coalesce(t.root, '') AS root, coalesce(t.depth, -1) AS depth, t.path FROM names n LEFT JOIN tree t ON n.chapter_id = t.chapter_id AND n.node = t.node",
    "p6_descendants": _TREE
    + """, up AS (
  SELECT l.chapter_id, l.parent AS ancestor, l.child AS descendant, CAST(1 AS BIGINT) AS distance FROM links l JOIN tree t ON t.chapter_id = l.chapter_id AND t.node = l.child
  UNION ALL
  SELECT u.chapter_id, l.parent, u.descendant, u.distance + 1 FROM up u JOIN links l ON l.chapter_id = u.chapter_id AND l.child = u.ancestor
) SELECT chapter_id, ancestor, descendant, distance FROM up""",
}
