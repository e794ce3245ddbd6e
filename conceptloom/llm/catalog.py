"""Queries and SQL of the operators for training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptloom.functions.text import id_form
from conceptloom.llm.components import concept_groups
from conceptloom.llm.language import detect_segments, fit_model, mislabelled
from conceptloom.llm.leakage import leaks
from conceptloom.llm.nearest import all_frames, frame_units
from conceptloom.llm.packing import pack_documents
from conceptloom.llm.residue import contentless
from conceptloom.llm.splitting import split_items, text_items
from conceptloom.llm.survivors import choose_survivors, merged_aliases, merged_concepts
from conceptloom.runtime import table


def _items(spark: SparkSession, d: str) -> DataFrame:
    return text_items(table(spark, d, "stage3_transcripts"), table(spark, d, "stage5_segments"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return split_items(_items(spark, d)).filter("piece = 2").select("item_table", "item_id").distinct()


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_items(_items(spark, d).filter("char_length(text) > 2000").dropDuplicates(["item_table", "item_id"]))


def p1_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The text that each oversized item's pieces give back, and whether all pieces are within the limit and overlap."""
    pieces = p1_pieces(spark, d)
    fresh = F.expr("substring(piece_text, overlap + 1)")
    whole = F.array_sort(F.collect_list(F.struct("piece", fresh.alias("t"))))
    fine = (F.char_length("piece_text") <= 2000) & F.when(F.col("piece") == 1, F.col("overlap") == 0).otherwise(F.col("overlap").between(1, 108))
    got = pieces.groupBy("item_table", "item_id").agg(whole.alias("w"), F.bool_and(fine).alias("fine"), (F.max("piece") == F.count(F.lit(1))).alias("numbered"))
    return got.select("item_table", "item_id", F.md5(F.array_join(F.transform("w", lambda x: x.t), "")).alias("text_md5"), "fine", "numbered")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return frame_units(table(spark, d, "stage2_selected_frames"), table(spark, d, "stage3_transcripts")).select("frame_path", "unit_id")


def p2_frames(spark: SparkSession, d: str) -> DataFrame:
    return all_frames(table(spark, d, "stage2_selected_frames"), table(spark, d, "stage3_transcripts")).select("frame_path", "unit_id", "distance")


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return concept_groups(table(spark, d, "stage7_id_remap"), table(spark, d, "stage6_raw_concepts"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d).filter("group_id < concept_id").select("group_id", "concept_id")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every concept with its group; one without links is its own."""
    raw = table(spark, d, "stage6_raw_concepts").select(id_form("concept_id").alias("concept_id")).filter("concept_id <> ''").distinct()
    return raw.join(_groups(spark, d), "concept_id", "full").select("concept_id", F.coalesce("group_id", "concept_id").alias("group_id"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return choose_survivors(table(spark, d, "stage6_raw_concepts"), _groups(spark, d))


def p5_concepts(spark: SparkSession, d: str) -> DataFrame:
    return merged_concepts(table(spark, d, "stage6_raw_concepts"), _groups(spark, d))


def p5_aliases(spark: SparkSession, d: str) -> DataFrame:
    return merged_aliases(table(spark, d, "stage6_raw_concepts"), _groups(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d)
    return mislabelled(items, fit_model(table(spark, d, "lang_samples"), items)).select("item_table", "item_id", "lang").distinct()


def p7_segments(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d)
    return detect_segments(items, fit_model(table(spark, d, "lang_samples"), items)).distinct()


def p8_sequences(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("item_id", "doc_id")


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Leaks by a run of ten words or by tiles that cover half of the item, passages in another order included."""
    return leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), least_coverage=0.5)


def p9_classes(spark: SparkSession, d: str) -> DataFrame:
    """For each passage text, as copies of a document are one class: its documents' class, its number of copies and of leaked items."""
    documents = table(spark, d, "documents")
    found = leaks(documents, table(spark, d, "eval_items")).select("item_id", "doc_id")
    class_ = documents.select("doc_id", F.md5("text").alias("class_id"))
    return found.join(class_, "doc_id").groupBy("class_id").agg(F.count_distinct("doc_id").alias("n_documents"), F.count_distinct("item_id").alias("n_items"), F.min("doc_id").alias("first_doc"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return contentless(table(spark, d, "documents")).select("doc_id")


def p10_reasons(spark: SparkSession, d: str) -> DataFrame:
    return contentless(table(spark, d, "documents"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_pieces, p1_round_trip, p2_found, p2_frames, p3_found, p3_groups, p5_found, p5_concepts, p5_aliases, p7_found, p7_segments, p8_sequences, p9_found, p9_leaks, p9_classes, p10_found, p10_reasons)
}


def _blanks(c: str) -> str:
    return f"regexp_replace({c}, '^[ \\t\\x{{00A0}}]+|[ \\t\\x{{00A0}}]+$', '', 'g')"


def _name(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '[ \\t\\x{{00A0}}]+', ' ', 'g')))"


# Neighbouring pairs by distance: every unit within the tolerance of every frame, the best kept.
_NEAREST = """
WITH f AS (SELECT DISTINCT frame_path, video_path, timestamp_sec AS t FROM stage2_selected_frames WHERE timestamp_sec IS NOT NULL AND NOT isnan(timestamp_sec)),
u AS (
  SELECT DISTINCT source_path, unit_id, span_start AS a, least(span_start, span_end) AS lo, greatest(span_start, span_end) AS hi FROM stage3_transcripts
  WHERE source_type = 'video' AND span_start IS NOT NULL AND span_end IS NOT NULL AND NOT (span_start = 0 AND span_end = 0)
), m AS (
  SELECT f.frame_path, u.unit_id, greatest(0, lo - t, t - hi) AS distance, abs(t - a) AS off FROM f JOIN u ON u.source_path = f.video_path AND t BETWEEN lo - 3 AND hi + 3
), best AS (
  SELECT frame_path, unit_id, distance FROM m WHERE distance <= 2.5
  QUALIFY row_number() OVER (PARTITION BY frame_path ORDER BY distance, off, unit_id) = 1
)
"""
# Components by spreading the smallest id along links until it is everywhere.
_GROUPS = f"""
WITH RECURSIVE named AS (
  SELECT DISTINCT lower({_blanks("concept_id")}) AS id, chapter_id, {_name("name")} AS name FROM stage6_raw_concepts WHERE chapter_id IS NOT NULL AND {_name("name")} <> ''
), pairs AS (
  SELECT lower({_blanks("old_id")}) AS a, lower({_blanks("canonical_id")}) AS b FROM stage7_id_remap
  UNION SELECT id, min(id) OVER (PARTITION BY chapter_id, name) FROM named
), links AS (SELECT a, b FROM pairs WHERE a <> '' AND b <> '' AND a <> b UNION SELECT b, a FROM pairs WHERE a <> '' AND b <> '' AND a <> b),
spread AS (
  SELECT a AS concept_id, a AS seen FROM links UNION SELECT l.b, s.seen FROM spread s JOIN links l ON l.a = s.concept_id
), groups AS (SELECT concept_id, min(seen) AS group_id FROM spread GROUP BY 1)
"""
_RANKED = (
    _GROUPS
    + f""", rows AS (
  SELECT DISTINCT g.group_id, lower({_blanks("c.concept_id")}) AS concept_id, CASE WHEN confidence BETWEEN 0 AND 1 THEN confidence END AS trust, frequency, extracted_at,
    coalesce(length({_blanks("definition")}), 0) AS size, {_blanks("definition")} AS definition, {_blanks("name")} AS shown, {_name("name")} AS form,
    name, type, domain, chapter_id, source_type
  FROM stage6_raw_concepts c JOIN groups g ON g.concept_id = lower({_blanks("c.concept_id")})
), chosen AS (
  SELECT group_id, first(concept_id ORDER BY trust DESC NULLS LAST, frequency DESC NULLS LAST, extracted_at DESC NULLS LAST, concept_id) AS survivor_id,
    first(concept_id ORDER BY size DESC, concept_id) AS definition_id, count(*) AS n_members, coalesce(sum(frequency), 0) AS frequency, min(extracted_at) AS first_at, max(extracted_at) AS last_at
  FROM rows GROUP BY 1 HAVING count(*) > 1
)
"""
)
SQL = {
    "p1_found": """SELECT DISTINCT * FROM (
  SELECT 'stage3_transcripts' AS item_table, unit_id AS item_id FROM stage3_transcripts WHERE length(raw_text) > 2000
  UNION ALL SELECT 'stage5_segments', segment_id FROM stage5_segments WHERE length(merged_text) > 2000)""",
    "p1_round_trip": """SELECT DISTINCT item_table, item_id, md5(text) AS text_md5, true AS fine, true AS numbered FROM (
  SELECT 'stage3_transcripts' AS item_table, unit_id AS item_id, raw_text AS text FROM stage3_transcripts WHERE length(raw_text) > 2000
  UNION ALL SELECT 'stage5_segments', segment_id, merged_text FROM stage5_segments WHERE length(merged_text) > 2000)""",
    "p9_classes": """WITH runs AS (
  SELECT id, is_doc, array_to_string(w[i : i + 9], ' ') AS run FROM (
    SELECT id, is_doc, w, unnest(range(1, len(w) - 8)) AS i FROM (
      SELECT doc_id AS id, true AS is_doc, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents
      UNION ALL SELECT item_id, false, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM eval_items))),
found AS (SELECT DISTINCT i.id AS item_id, d.id AS doc_id FROM runs i JOIN runs d ON d.run = i.run AND d.is_doc AND NOT i.is_doc)
SELECT md5(text) AS class_id, count(DISTINCT doc_id) AS n_documents, count(DISTINCT item_id) AS n_items, min(doc_id) AS first_doc FROM found JOIN documents USING (doc_id) GROUP BY 1""",
    "p2_found": _NEAREST + "SELECT frame_path, unit_id FROM best",
    "p2_frames": _NEAREST + "SELECT f.frame_path, best.unit_id, best.distance FROM (SELECT DISTINCT frame_path FROM stage2_selected_frames) f LEFT JOIN best USING (frame_path)",
    "p3_found": _GROUPS + "SELECT group_id, concept_id FROM groups WHERE group_id < concept_id",
    "p3_groups": _GROUPS
    + f"""SELECT concept_id, coalesce(group_id, concept_id) AS group_id
FROM (SELECT DISTINCT lower({_blanks("concept_id")}) AS concept_id FROM stage6_raw_concepts WHERE {_blanks("concept_id")} <> '') FULL JOIN groups USING (concept_id)""",
    "p9_found": """WITH runs AS (
  SELECT id, is_doc, array_to_string(w[i : i + 9], ' ') AS run FROM (
    SELECT id, is_doc, w, unnest(range(1, len(w) - 8)) AS i FROM (
      SELECT doc_id AS id, true AS is_doc, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents
      UNION ALL SELECT item_id, false, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM eval_items)))
SELECT DISTINCT i.id AS item_id, d.id AS doc_id FROM runs i JOIN runs d ON d.run = i.run AND d.is_doc AND NOT i.is_doc""",
    "p5_found": _RANKED + "SELECT group_id, survivor_id, definition_id FROM chosen",
    "p5_concepts": _RANKED
    + """SELECT c.group_id, survivor_id, definition_id, s.name, s.type, s.domain, s.chapter_id, s.source_type, s.trust AS confidence, t.definition,
  CAST(n_members AS BIGINT) AS n_members, CAST(c.frequency AS BIGINT) AS frequency, first_at AT TIME ZONE 'UTC' AS first_at, last_at AT TIME ZONE 'UTC' AS last_at
FROM chosen c JOIN rows s ON s.concept_id = survivor_id JOIN rows t ON t.concept_id = definition_id""",
    "p5_aliases": _RANKED
    + """SELECT r.group_id, min(r.shown) AS alias FROM rows r JOIN chosen c USING (group_id) JOIN rows s ON s.concept_id = c.survivor_id
WHERE r.form <> '' AND r.form IS DISTINCT FROM s.form GROUP BY r.group_id, r.form""",
}
