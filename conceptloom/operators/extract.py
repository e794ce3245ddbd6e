"""Parsers of extracted lines: one row in, many rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptloom.adapters import prompt
from conceptloom.config import CONCEPT_TYPES, DEFAULTS, RELATIONS, EngineConfig
from conceptloom.functions.text import confidence_of, digits_clamped, lines, pipe_parts, relation_form, strip_white, think_stripped


def _lines(df: DataFrame, key: str, text: str) -> DataFrame:
    rows = df.select(key, F.posexplode(lines(text)).alias("line_no", "line")).withColumn("line", strip_white("line"))
    return rows.filter((F.col("line") != "") & ~F.startswith("line", F.lit("#"))).withColumn("p", pipe_parts("line"))


def _first(df: DataFrame, key: str, most: int | None) -> DataFrame:
    if most is None:
        return df
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy("line_no"))).filter(F.col("__r") <= most).drop("__r")


def _part(i: int) -> Column:
    return F.get("p", F.lit(i))


def concept_lines(df: DataFrame, key: str, text: str, most: int | None = None) -> DataFrame:
    """NAME | TYPE | DEFINITION lines: (key, line_no, name, type, definition). Blank and # lines, lines of fewer than three
    parts and names of 0 or over 120 characters are skipped, further parts ignored; an unknown type is a fact."""
    rows = _lines(df, key, text).filter(F.size("p") >= 3).filter(F.char_length(_part(0)).between(1, 120))
    kind = F.lower(_part(1))
    out = rows.select(key, "line_no", _part(0).alias("name"), F.when(kind.isin(CONCEPT_TYPES), kind).otherwise("fact").alias("type"), _part(2).alias("definition"))
    return _first(out, key, most)


def relation_lines(df: DataFrame, key: str, text: str, most: int | None = None) -> DataFrame:
    """SOURCE | RELATION | TARGET [| CONFIDENCE] lines: an unknown relation is 'explains', no number gives 0.8."""
    rows = _lines(df, key, text).filter(F.size("p") >= 3).filter((_part(0) != "") & (_part(2) != ""))
    relation = relation_form(_part(1))
    out = rows.select(
        key,
        "line_no",
        _part(0).alias("source_name"),
        F.when(relation.isin(RELATIONS), relation).otherwise("explains").alias("relation"),
        _part(2).alias("target_name"),
        confidence_of(F.coalesce(_part(3), F.lit(""))).alias("confidence"),
    )
    return _first(out, key, most)


def prerequisite_lines(df: DataFrame, key: str, text: str, most: int | None = None) -> DataFrame:
    """A | requires | B lines, whatever stands in the middle: confidence 0.85, is_prereq."""
    rows = _lines(df, key, text).filter(F.size("p") >= 3).filter((_part(0) != "") & (_part(2) != ""))
    out = rows.select(key, "line_no", _part(0).alias("source_name"), F.lit("requires").alias("relation"), _part(2).alias("target_name"), F.lit(0.85).alias("confidence"), F.lit(True).alias("is_prereq"))
    return _first(out, key, most)


def is_question(text: Column) -> Column:
    return F.startswith(strip_white(text), F.lit("Q:")) & F.contains(text, F.lit("A:"))


def question_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """Q:, A: and Wrong: lines, the last of each wins: (key, question, answer, n_wrong); none without Q and A."""
    rows = df.select(key, F.posexplode(lines(text)).alias("line_no", "line")).withColumn("line", strip_white("line"))
    last = lambda mark: F.max(F.when(F.startswith("line", F.lit(mark)), F.struct("line_no", F.expr(f"substring(line, {len(mark) + 1})").alias("v"))))
    got = rows.groupBy(key).agg(last("Q:").alias("q"), last("A:").alias("a"), last("Wrong:").alias("w"))
    got = got.select(key, strip_white("q.v").alias("question"), strip_white("a.v").alias("answer"), F.filter(F.transform(F.split("w.v", ","), strip_white), lambda x: x != "").alias("wrong"))
    return got.filter((F.col("question") != "") & (F.col("answer") != ""))


def question_concepts(questions: DataFrame, key: str) -> DataFrame:
    """A fact for each question (name cut to 100 characters) and an example for each wrong answer (80)."""
    fact = questions.select(key, F.substring("question", 1, 100).alias("name"), F.lit("fact").alias("type"), F.col("answer").alias("definition"), F.lit(0.9).alias("confidence"))
    wrong = questions.select(key, F.explode("wrong").alias("w")).select(key, F.substring("w", 1, 80).alias("name"), F.lit("example").alias("type"), F.lit("").alias("definition"), F.lit(0.6).alias("confidence"))
    return fact.unionByName(wrong)


def question_relations(questions: DataFrame, key: str) -> DataFrame:
    """Each wrong answer contrasts with its question."""
    return questions.select(key, F.substring("question", 1, 100).alias("source_name"), F.lit("contrasts_with").alias("relation"), F.explode("wrong").alias("w")).select(
        key, "source_name", "relation", F.substring("w", 1, 80).alias("target_name"), F.lit(0.7).alias("confidence")
    )


def _named(c: Column, most: int | None = None) -> Column:
    """The parts of a comma-separated text that aren't blank."""
    parts = F.filter(F.transform(F.split(c, ","), strip_white), lambda x: x != "")
    return parts if most is None else F.slice(parts, 1, most)


def topic_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """TITLE | SUMMARY | CONCEPTS | DIFFICULTY, the first line that isn't blank: (key, title, summary, top_concepts, difficulty), the
    title cut to 80 characters, at most three concepts, the difficulty's digits between 1 and 5, 2 without any."""
    rows = _first(_lines(df, key, text), key, 1)
    return rows.select(key, F.substring(_part(0), 1, 80).alias("title"), F.coalesce(_part(1), F.lit("")).alias("summary"), _named(F.coalesce(_part(2), F.lit("")), 3).alias("top_concepts"), digits_clamped(F.coalesce(_part(3), F.lit(""))).alias("difficulty"))


def chapter_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """TITLE | SUMMARY | DOMAINS, the first line that isn't blank: (key, title, summary, domains), the title cut to 100 characters."""
    rows = _first(_lines(df, key, text), key, 1)
    return rows.select(key, F.substring(_part(0), 1, 100).alias("title"), F.coalesce(_part(1), F.lit("")).alias("summary"), _named(F.coalesce(_part(2), F.lit(""))).alias("domains"))


def pass_prompts(segments: DataFrame, templates: dict[str, str], concepts: DataFrame | None = None, limit: int = 800) -> DataFrame:
    """(segment_id, pass, prompt): the first pass over every segment, the second and third over those in which the first found
    concepts (segment_id, line_no, name), with a list of them and the first ``limit`` characters of the text."""
    text, domain = F.coalesce("merged_text", F.lit("")), F.coalesce(F.nullif("domain", F.lit("")), F.lit("general"))
    if concepts is None:
        return segments.select("segment_id", F.lit(1).alias("pass"), prompt(templates["concepts"], domain=domain, merged_text=text).alias("prompt"))
    listed = concepts.groupBy("segment_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "name"))).alias("l"))  # at most as many as a reply has lines
    names = F.array_join(F.transform("l", lambda x: F.concat(F.lit("- "), x["name"])), "\n")
    made = segments.join(listed, "segment_id").withColumn("p", F.explode(F.array(*[
        F.struct(F.lit(k).alias("pass"), prompt(templates[t], concept_list=names, context_short=F.substring(text, 1, limit)).alias("prompt")) for k, t in ((2, "relations"), (3, "prerequisites"))
    ])))
    return made.select("segment_id", "p.*")


def extracted(segments: DataFrame, replies: DataFrame, config: EngineConfig = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(concepts, relations) of segments (segment_id, merged_text) from replies (segment_id, pass, reply) and from question texts.

    Segments that are questions and answers are parsed themselves, the others by their replies: concepts of the first pass;
    relations and prerequisites of the second and third only where the first gave a concept. Both tables unite all rows.
    """
    asks = is_question(F.coalesce("merged_text", F.lit("")))
    said = lambda k: replies.filter(F.col("pass") == k).join(segments.filter(~asks).select("segment_id"), "segment_id", "left_semi").withColumn("reply", think_stripped("reply"))
    found = concept_lines(said(1), "segment_id", "reply", config.max_concepts)
    some = found.select("segment_id").distinct()
    questions = question_lines(segments.filter(asks), "segment_id", "merged_text")
    base = F.lit(config.first_confidence).alias("confidence")
    concepts = found.select("segment_id", "name", "type", "definition", base).unionByName(question_concepts(questions, "segment_id"))
    second = relation_lines(said(2), "segment_id", "reply", config.max_relations).select("segment_id", "source_name", "relation", "target_name", "confidence", F.lit(None).cast("boolean").alias("is_prereq"))
    third = prerequisite_lines(said(3), "segment_id", "reply", config.max_prerequisites).select("segment_id", "source_name", "relation", "target_name", "confidence", "is_prereq")
    asked = question_relations(questions, "segment_id").withColumn("is_prereq", F.lit(False))
    return concepts, second.unionByName(third).join(some, "segment_id", "left_semi").unionByName(asked)
