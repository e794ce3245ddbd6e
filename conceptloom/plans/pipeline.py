"""Queries of the engine's own operators over the stage tables and the star schema."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conceptloom.config import DEFAULTS, DOMAINS
from conceptloom.functions.text import digits_clamped, name_form, normal_name, think_stripped
from conceptloom.adapters import embedder_for, hashed_embedding, language_of, pending
from conceptloom.operators import clusters, extract, frames, graph, ordered, pairs, prereqs, resolve, segments, topics
from conceptloom.runtime import Scratch, table
from conceptloom.sources import readers, sinks

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _units(s, d):
    return table(s, d, "stage3_transcripts")


def _segs(s, d):
    return table(s, d, "stage5_segments")


def _frames(s, d):
    return table(s, d, "stage2_selected_frames")


def _raw(s, d):
    return table(s, d, "stage6_raw_concepts")


def _rels(s, d):
    return table(s, d, "stage6_raw_relations")


def _canon(s, d):
    return table(s, d, "stage7_canonical_concepts")


def _vectors(s, d):
    return table(s, d, "embeddings")


# Sources and shapes of text


@query
def route_by_type(s: SparkSession, d: str) -> DataFrame:
    return _units(s, d).groupBy(readers.source_kind(F.col("source_path")).alias("kind"), "source_type").agg(F.count(F.lit(1)).alias("n"))


@query
def text_units_ordinal(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ordinal", "line"))
    return rows.filter(F.trim("line") != "").select("doc_id", F.col("ordinal").cast("long").alias("ordinal"), F.md5("line").alias("line_md5"))


@query
def page_chunks_of_3(s: SparkSession, d: str) -> DataFrame:
    pages = _units(s, d).filter("source_type = 'pdf'").dropDuplicates(["unit_id"])
    return readers.page_chunks(pages, "source_path", "unit_seq", "raw_text").select("source_path", "chunk", "first_page", "last_page", F.md5("chunk_text").alias("chunk_md5"))


@query
def qa_units(s: SparkSession, d: str) -> DataFrame:
    wrong = F.when(F.col("exam") != "", F.concat(F.lit("Wrong: "), F.col("exam"))).otherwise("")
    return table(s, d, "eval_items").select("item_id", readers.question_text(F.col("text"), F.col("answer"), wrong).alias("unit_text"))


@query
def merge_context(s: SparkSession, d: str) -> DataFrame:
    return segments.merged_context(_units(s, d)).select("unit_id", F.md5("context").alias("context_md5")).distinct()


@query
def chunk_words(s: SparkSession, d: str) -> DataFrame:
    return segments.first_words(table(s, d, "documents"), "doc_id", "text", 64).select("doc_id", F.md5("head").alias("head_md5"))


@query
def sentence_chunks(s: SparkSession, d: str) -> DataFrame:
    return segments.whole_sentences(table(s, d, "documents"), "doc_id", "text", 40).select("doc_id", F.md5("chunk").alias("chunk_md5"))


@query
def caption_join(s: SparkSession, d: str) -> DataFrame:
    made = _frames(s, d).dropDuplicates(["frame_path"]).select("unit_id", F.col("frame_num").alias("place"), F.concat(F.lit("frame "), F.regexp_extract("frame_path", "([^/]*)$", 1)).alias("caption"))
    got = segments.with_captions(_units(s, d), made, frames.frames_by_unit(_frames(s, d)))
    return got.select("unit_id", F.md5("visual_caption").alias("caption_md5"), F.md5("keyframes").alias("keyframes_md5"))


@query
def text_embeddings(s: SparkSession, d: str) -> DataFrame:
    """The default embedder's vectors: the places that aren't 0, with sign and rank of the size among the unit's."""
    rows = _units(s, d).dropDuplicates(["unit_id"]).select("unit_id", F.posexplode(hashed_embedding(F.col("raw_text"))).alias("place", "value"))
    size = F.dense_rank().over(Window.partitionBy("unit_id").orderBy(F.abs("value")))  # at most 64 rows to a unit
    return rows.filter("value <> 0").select("unit_id", F.col("place").cast("long").alias("place"), (F.col("value") > 0).alias("up"), size.cast("long").alias("size"))


@query
def modality_coverage(s: SparkSession, d: str) -> DataFrame:
    return _units(s, d).groupBy("chapter_id").agg(F.count_distinct("source_type").alias("n_types"), F.count_distinct("source_path").alias("n_sources"), F.count_distinct("unit_id").alias("n_units"))


# Texts as files would hold them, made of the tables, through the readers


@query
def read_cues(s: SparkSession, d: str) -> DataFrame:
    """Subtitles of each video made of its units, read back as cues."""
    clock = lambda c: F.concat(F.format_string("%02d:%02d:%02d", (F.col(c) / 3600).cast("int"), (F.col(c) % 3600 / 60).cast("int"), (F.col(c) % 60).cast("int")), F.lit(","), F.format_string("%03d", F.floor(F.col(c) * 1000).cast("long") % 1000))
    rows = _units(s, d).filter("source_type = 'video' AND span_start >= 0 AND span_end >= 0").dropDuplicates(["unit_id"])
    block = F.concat(clock("span_start"), F.lit(" --> "), clock("span_end"), F.lit("\n"), F.regexp_replace(F.coalesce("raw_text", F.lit("")), r"[\r\n]+", " "))
    texts = rows.groupBy(F.col("source_path").alias("path")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_seq", "unit_id", block.alias("b")))), lambda x: x.b), "\n\n").alias("text"))
    return readers.cue_units_of(texts, "c").groupBy("source_path").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.round("span_start", 3)), 3).alias("starts"), F.sum(F.char_length("raw_text")).alias("characters"))


@query
def read_questions(s: SparkSession, d: str) -> DataFrame:
    """Exam items as question banks, one for each exam, read back as units."""
    item = F.struct(F.col("text").alias("question"), "answer", F.array("exam", "lang").alias("wrong"))
    texts = table(s, d, "eval_items").groupBy(F.col("exam").alias("path")).agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("item_id", item.alias("i")))), lambda x: x.i).alias("items"))).alias("text"))
    return readers.question_units_of(texts, "c").select("source_path", "unit_seq", "confidence", F.md5("raw_text").alias("text_md5"))


@query
def read_transcripts(s: SparkSession, d: str) -> DataFrame:
    """Units of each video as transcript JSON, read back as text units."""
    rows = _units(s, d).filter("source_type = 'video'").dropDuplicates(["unit_id"])
    item = F.struct(F.col("span_start").alias("start"), F.col("span_end").alias("end"), F.col("raw_text").alias("text"))
    texts = rows.groupBy(F.col("source_path").alias("path")).agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("unit_seq", "unit_id", item.alias("i")))), lambda x: x.i).alias("segments"))).alias("text"))
    return readers.transcript_units_of(texts, "c").select("source_path", "unit_seq", "source_type", "span_start", "span_end", F.md5("raw_text").alias("text_md5"))


@query
def read_unknown_json(s: SparkSession, d: str) -> DataFrame:
    texts = table(s, d, "eval_items").select(F.col("exam").alias("path"), "item_id", F.when(F.col("item_id") % 3 == 0, F.lit("{broken")).otherwise(F.to_json(F.array("text", "answer"))).alias("text"))
    return readers.unknown_json_units_of(texts, "c").groupBy("source_path", "span_end").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("raw_text") == "[]").alias("empty"))


@query
def read_texts(s: SparkSession, d: str) -> DataFrame:
    """Documents as text files in the order of their names, blank ones counted."""
    texts = table(s, d, "documents").select(F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("path"), "text")
    return readers.text_units_of(texts, "c").select("source_path", F.col("unit_seq").alias("ordinal"), F.md5("raw_text").alias("text_md5"))


@query
def read_json_lines(s: SparkSession, d: str) -> DataFrame:
    """Transcript units written as JSON lines and read again."""
    path = Scratch(s, "jsonl").base + "/units"
    sinks.write_json_lines(_units(s, d).select("unit_id", "raw_text", "span_start").distinct(), path)
    return readers.json_lines(s, path, "unit_id string, raw_text string, span_start double").select("unit_id", F.md5("raw_text").alias("text_md5"), "span_start", F.col("_corrupt").isNull().alias("whole"))


@query
def visual_pages(s: SparkSession, d: str) -> DataFrame:
    return readers.visual_pages(_units(s, d)).select("unit_id").distinct()


@query
def page_units(s: SparkSession, d: str) -> DataFrame:
    """Pages of at least 40 words in threes, the others as images where they have one."""
    pages = _units(s, d).filter("source_type = 'pdf'").dropDuplicates(["unit_id"]).select(F.col("source_path").alias("path"), F.col("unit_seq").alias("page"), F.col("raw_text").alias("text"), F.when(F.col("unit_seq") % 2 == 0, F.concat(F.col("source_path"), F.lit(".png"))).alias("image"))
    return readers.page_units(pages, "c", 40).select("source_path", "unit_seq", "span_start", "span_end", F.md5("raw_text").alias("text_md5"), F.array_join("keyframe_paths", ",").alias("images"))


@query
def video_units(s: SparkSession, d: str) -> DataFrame:
    """A unit for each video of the frames; those of even names were probed."""
    listed = _frames(s, d).select(F.col("video_path").alias("path"), F.lit("video").alias("kind")).distinct()
    probe = _frames(s, d).filter(F.char_length("video_path") % 2 == 0).groupBy(F.col("video_path").alias("path")).agg(F.max("timestamp_sec").alias("duration"), F.min("subtype").alias("subtype"))
    return readers.media_units(listed, "video", "c", probe).select("source_path", "video_subtype", "span_end")


@query
def clusters_by_subtype(s: SparkSession, d: str) -> DataFrame:
    return frames.clusters_by_subtype(_frames(s, d), {"lecture": 12, "animation": 30, "lab": 1}, 25)


@query
def languages_of_units(s: SparkSession, d: str) -> DataFrame:
    language = language_of(F.col("lang"))
    return _units(s, d).select("unit_id", language.alias("language"), embedder_for(language, "small", "multilingual").alias("embedder")).distinct()


def _replies(s, d):
    """What was extracted of each segment, as the replies of the three passes."""
    joined = lambda rows, seq: rows.groupBy("segment_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(seq, "raw_line"))), lambda x: x.raw_line), "\n").alias("reply"))
    rels = _rels(s, d).dropDuplicates(["relation_id"])
    one = joined(_raw(s, d).dropDuplicates(["concept_id"]).select("segment_id", F.col("concept_seq").alias("q"), "raw_line"), "q").withColumn("pass", F.lit(1))
    two = joined(rels.filter("relation <> 'requires'").select("segment_id", F.col("relation_seq").alias("q"), "raw_line"), "q").withColumn("pass", F.lit(2))
    return one.unionByName(two).unionByName(joined(rels.filter("relation = 'requires'").select("segment_id", F.col("relation_seq").alias("q"), "raw_line"), "q").withColumn("pass", F.lit(3)))


@query
def extracted_concepts(s: SparkSession, d: str) -> DataFrame:
    got, _ = extract.extracted(_segs(s, d).dropDuplicates(["segment_id"]), _replies(s, d))
    return got.select("segment_id", "name", "type", F.md5("definition").alias("definition_md5"), "confidence")


@query
def extracted_relations(s: SparkSession, d: str) -> DataFrame:
    return extract.extracted(_segs(s, d).dropDuplicates(["segment_id"]), _replies(s, d))[1]


# Spans, frames and segments


@query
def transcript_overlap(s: SparkSession, d: str) -> DataFrame:
    spans = _segs(s, d).dropDuplicates(["segment_id"]).select(F.col("segment_id").alias("id"), F.explode(F.array_distinct("source_paths")).alias("entity"), F.col("span_start").alias("start"), F.col("span_end").alias("stop"))
    cues = _units(s, d).filter("source_type = 'video'").dropDuplicates(["unit_id"]).select("unit_id", F.col("source_path").alias("entity"), F.col("span_start").alias("start"), F.col("span_end").alias("stop"))
    met = segments.overlapping(spans, cues)
    return met.groupBy(F.col("id").alias("segment_id")).agg(F.count(F.lit(1)).alias("n_cues"), F.min("unit_id").alias("first_id"))


@query
def transcript_fallback(s: SparkSession, d: str) -> DataFrame:
    """Texts of the cues that meet each segment's span, else of the whole source."""
    spans = _segs(s, d).dropDuplicates(["segment_id"]).select(F.col("segment_id").alias("unit_id"), F.col("source_paths")[0].alias("entity"), F.col("span_start").alias("start"), F.col("span_end").alias("stop"))
    cues = _units(s, d).filter("source_type = 'video'").dropDuplicates(["unit_id"]).select(F.col("source_path").alias("entity"), F.col("span_start").alias("start"), F.col("span_end").alias("stop"), F.struct("unit_seq", "unit_id").alias("place"), F.coalesce("raw_text", F.lit("")).alias("text"))
    return segments.transcript_texts(spans, cues).select(F.col("unit_id").alias("segment_id"), F.md5("text").alias("text_md5"))


@query
def point_in_interval(s: SparkSession, d: str) -> DataFrame:
    return segments.aligned_keyframes(_segs(s, d), _frames(s, d)).select("segment_id", "n_frames", "keyframes")


@query
def quality_cascade(s: SparkSession, d: str) -> DataFrame:
    reason = frames.quality_reason(F.col("l_quantity"), F.col("l_extendedprice") / 100, F.col("l_discount") * 10, 5.0, 30.0, 200.0, 0.4)
    return table(s, d, "lineitem").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query
def frame_timestamps(s: SparkSession, d: str) -> DataFrame:
    return frames.frame_times(_frames(s, d), 2.0).select("frame_path", "number", "at")


@query
def topk_cap(s: SparkSession, d: str) -> DataFrame:
    return frames.densest_frames(_frames(s, d), 10).select("video_path", "frame_path", F.col("place").cast("long").alias("place"))


@query
def unit_frames(s: SparkSession, d: str) -> DataFrame:
    return frames.frames_by_unit(_frames(s, d))


@query
def frame_units(s: SparkSession, d: str) -> DataFrame:
    return frames.with_unit_ids(_frames(s, d).dropDuplicates(["frame_path"]), _units(s, d)).select("frame_path", "unit_id")


@query
def boundary_source(s: SparkSession, d: str) -> DataFrame:
    return segments.source_boundaries(_units(s, d)).filter("boundary").select("unit_id")


@query
def boundary_cosine(s: SparkSession, d: str) -> DataFrame:
    return segments.similarity_boundaries(_vectors(s, d), "label", "vec_id", "embedding", 0.0).select("vec_id", F.round("similarity", 6).alias("similarity"))


@query
def boundary_duration(s: SparkSession, d: str) -> DataFrame:
    return segments.duration_boundaries(_units(s, d), replace(DEFAULTS, segment_max_seconds=4.0)).distinct()


@query
def boundary_union(s: SparkSession, d: str) -> DataFrame:
    return segments.all_boundaries(_units(s, d)).filter("boundary").select("unit_id")


@query
def sessionize_capped(s: SparkSession, d: str) -> DataFrame:
    return segments.segments(_units(s, d)).select("unit_id", "session", "part")


@query
def segment_rollup(s: SparkSession, d: str) -> DataFrame:
    return segments.segment_rollup(_units(s, d)).select(
        "chapter_id", "session", "part", "span_start", "span_end", "unit_count", F.md5("unit_ids").alias("ids_md5"), "source_types", F.md5("source_paths").alias("paths_md5"), F.md5("merged_text").alias("text_md5"), "keyframes"
    )


# With change points as well, which SQL can't say.


@query
def topic_sessions(s: SparkSession, d: str) -> DataFrame:
    return segments.topic_segments(_units(s, d)).select("unit_id", "session", "part")


@query
def topic_rollup(s: SparkSession, d: str) -> DataFrame:
    return segments.segment_rollup(_units(s, d), by=segments.topic_segments).select(
        "chapter_id", "session", "part", "span_start", "span_end", "unit_count", F.md5("unit_ids").alias("ids_md5"), "source_types", F.md5("source_paths").alias("paths_md5"), F.md5("merged_text").alias("text_md5"), "keyframes"
    )


@query
def split_long_units(s: SparkSession, d: str) -> DataFrame:
    units = _units(s, d).dropDuplicates(["unit_id"]).select("unit_id", "span_start", "span_end", F.coalesce("raw_text", F.lit("")).alias("text"))
    return segments.split_long(units, 4.0, 5).select("unit_id", "k", F.round("slice_start", 6).alias("slice_start"), F.round("slice_end", 6).alias("slice_end"), F.md5("slice_text").alias("slice_md5"))


@query
def validate_segments(s: SparkSession, d: str) -> DataFrame:
    return segments.valid_segments(_segs(s, d))


@query
def segment_domains(s: SparkSession, d: str) -> DataFrame:
    return segments.with_domains(_segs(s, d).dropDuplicates(["segment_id"]), "segment_id", "merged_text", segments.domain_seeds(s, {x: x for x in DOMAINS}))


@query
def pending_antijoin(s: SparkSession, d: str) -> DataFrame:
    """Units that no frame was taken for: what a frame stage has still to do."""
    return pending(_units(s, d).select("unit_id").distinct(), _frames(s, d).filter("unit_id <> ''"), "unit_id")


# Parsers


@query
def parse_pass1(s: SparkSession, d: str) -> DataFrame:
    got = extract.concept_lines(_raw(s, d).dropDuplicates(["concept_id"]), "concept_id", "raw_line", 20)
    return got.select("concept_id", "name", "type", F.md5("definition").alias("definition_md5"))


@query
def parse_pass2(s: SparkSession, d: str) -> DataFrame:
    return extract.relation_lines(_rels(s, d).dropDuplicates(["relation_id"]), "relation_id", "raw_line", 20).drop("line_no")


@query
def parse_pass3(s: SparkSession, d: str) -> DataFrame:
    got = extract.prerequisite_lines(_rels(s, d).filter("relation = 'requires'").dropDuplicates(["relation_id"]), "relation_id", "raw_line", 10)
    return got.select("relation_id", "source_name", "target_name", "confidence", "is_prereq")


@query
def parse_qa(s: SparkSession, d: str) -> DataFrame:
    got = extract.question_lines(table(s, d, "documents").filter(extract.is_question(F.col("text"))), "doc_id", "text")
    return got.select("doc_id", F.md5("question").alias("question_md5"), F.md5("answer").alias("answer_md5"), F.greatest(F.size("wrong"), F.lit(0)).cast("long").alias("n_wrong"))


@query
def think_strip(s: SparkSession, d: str) -> DataFrame:
    reply = F.concat(F.lit("<think>a\nb</think> "), F.col("raw_line"), F.lit("\t<think>x</think>"))
    return _raw(s, d).select("concept_id", F.md5(think_stripped(reply)).alias("reply_md5")).distinct()


@query
def digits_clamp(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select("p_partkey", digits_clamped("p_brand").cast("long").alias("level"))


@query
def topic_lines(s: SparkSession, d: str) -> DataFrame:
    got = extract.topic_lines(_raw(s, d).dropDuplicates(["concept_id"]), "concept_id", "raw_line")
    return got.withColumns({"difficulty": F.col("difficulty").cast("long"), "top_concepts": F.array_join("top_concepts", "|")})


@query
def chapter_lines(s: SparkSession, d: str) -> DataFrame:
    got = extract.chapter_lines(_raw(s, d).dropDuplicates(["concept_id"]), "concept_id", "raw_line")
    return got.withColumns({"summary": F.md5("summary"), "domains": F.array_join("domains", "|")})


# Names and concepts


@query
def normalize_names(s: SparkSession, d: str) -> DataFrame:
    return _raw(s, d).select("concept_id", normal_name("name").alias("norm"), name_form("name").alias("form")).distinct()


@query
def exact_name_groups(s: SparkSession, d: str) -> DataFrame:
    return resolve.exact_groups(_raw(s, d))


@query
def fuzzy_pairs(s: SparkSession, d: str) -> DataFrame:
    rows = _raw(s, d).select("chapter_id", F.lower("name").alias("norm"), "concept_seq").groupBy("chapter_id", "norm").agg(F.min("concept_seq").alias("seq"))
    return resolve.fuzzy_pairs(rows, "chapter_id", "seq", "norm", 90.0).select("chapter_id", "seq_a", "seq_b", F.round("ratio", 6).alias("ratio"))


@query
def leader_groups(s: SparkSession, d: str) -> DataFrame:
    return resolve.lexical_groups(_raw(s, d))


def _shown(concepts):
    """Canonical concepts with their lists as texts."""
    joined = lambda c: F.md5(F.array_join(c, "|"))
    return concepts.select(
        "chapter_id", "group", F.col("concept_id").alias("canonical_id"), "name", "type", "domain", F.md5("definition").alias("definition_md5"), F.col("frequency").cast("long").alias("frequency"), F.round("confidence", 6).alias("confidence"),
        F.size("aliases").cast("long").alias("n_aliases"), joined("aliases").alias("aliases_md5"), F.size("source_segments").cast("long").alias("n_segments"), joined("source_segments").alias("segments_md5"),
    )


@query
def canonical_concepts(s: SparkSession, d: str) -> DataFrame:
    return _shown(resolve.canonical_concepts(_raw(s, d))).withColumnRenamed("group", "form")


@query
def id_remap(s: SparkSession, d: str) -> DataFrame:
    return resolve.id_remap(_raw(s, d))


def _lexical(s, d):
    return resolve.lexical_groups(_raw(s, d)).select("concept_id", F.col("leader_seq").alias("group"))


@query
def mode_names(s: SparkSession, d: str) -> DataFrame:
    return resolve.mode_names(_raw(s, d), _lexical(s, d)).withColumnRenamed("group", "leader_seq")


@query
def fuzzy_concepts(s: SparkSession, d: str) -> DataFrame:
    """Canonical concepts of the fuzzy name groups."""
    return _shown(resolve.canonical_concepts(_raw(s, d), _lexical(s, d))).withColumnRenamed("group", "leader_seq")


@query
def fuzzy_remap(s: SparkSession, d: str) -> DataFrame:
    return resolve.id_remap(_raw(s, d), _lexical(s, d))


@query
def resolved_concepts(s: SparkSession, d: str) -> DataFrame:
    """From raw to canonical concepts: fuzzy groups, density clusters, triage; nothing was asked, so checks keep concepts apart."""
    groups = Scratch(s, "groups").save(resolve.resolved_groups(_raw(s, d)), "resolved")
    return _shown(resolve.canonical_concepts(_raw(s, d), groups))


@query
def resolved_remap(s: SparkSession, d: str) -> DataFrame:
    return resolve.id_remap(_raw(s, d), resolve.resolved_groups(_raw(s, d)))


@query
def remap_concepts(s: SparkSession, d: str) -> DataFrame:
    return resolve.remapped(_raw(s, d).select("concept_id", "concept_seq").distinct(), "concept_id", table(s, d, "stage7_id_remap"))


@query
def name_resolve_first(s: SparkSession, d: str) -> DataFrame:
    return resolve.resolved_relations(_rels(s, d), _canon(s, d)).select("relation_id", "source", "target")


@query
def name_resolve_last(s: SparkSession, d: str) -> DataFrame:
    return resolve.resolved_relations(_rels(s, d), _canon(s, d), last=True).select("relation_id", "source", "target")


# Prerequisites


@query
def edge_dedup_max(s: SparkSession, d: str) -> DataFrame:
    return prereqs.prerequisite_edges(_rels(s, d), _canon(s, d))


def _dag(s, d):
    return prereqs.break_cycles(prereqs.prerequisite_edges(_rels(s, d), _canon(s, d)))


@query
def break_cycles(s: SparkSession, d: str) -> DataFrame:
    return _dag(s, d)


@query
def prereq_depths(s: SparkSession, d: str) -> DataFrame:
    edges = prereqs.prerequisite_edges(_rels(s, d), _canon(s, d))
    return prereqs.depths(edges).filter("depth >= 0").select("chapter_id", "node", F.col("depth").cast("long").alias("depth"))


@query
def learning_depths(s: SparkSession, d: str) -> DataFrame:
    """Depths along the reversed edges of the acyclic graph: foundations first."""
    return prereqs.depths(_dag(s, d), source="target", target="source").select("chapter_id", "node", "depth")


@query
def depth_histogram(s: SparkSession, d: str) -> DataFrame:
    return prereq_depths(s, d).groupBy("depth").agg(F.count(F.lit(1)).alias("n"))


@query
def learning_order(s: SparkSession, d: str) -> DataFrame:
    got = prereq_depths(s, d)
    return ordered.running_counts(got, ["chapter_id"], ["depth", "node"], F.col("depth")).select("chapter_id", "node", F.col("n").alias("place"))


@query
def acyclic_chapters(s: SparkSession, d: str) -> DataFrame:
    """Whether each chapter's prerequisites are free of cycles, as stated and after the weakest edges were taken away."""
    edges = Scratch(s, "acyclic").save(prereqs.prerequisite_edges(_rels(s, d), _canon(s, d)), "edges")
    after = prereqs.acyclic(prereqs.break_cycles(edges)).withColumnRenamed("acyclic", "after")
    return prereqs.acyclic(edges).withColumnRenamed("acyclic", "before").join(after, "chapter_id", "left")


@query
def temporal_prereqs(s: SparkSession, d: str) -> DataFrame:
    v = _vectors(s, d).withColumn("scope", F.lit(0))
    return prereqs.temporal_edges(v, "scope", "label", "vec_id", "embedding", 0.3, 201).select("source", "target", F.round("confidence", 6).alias("confidence"))


@query
def temporal_concepts(s: SparkSession, d: str) -> DataFrame:
    """Later concepts of a chapter that resemble earlier ones, without the prerequisites that are there."""
    v = Scratch(s, "temporal").save(prereqs.concept_vectors(_canon(s, d), _segs(s, d)), "vectors")
    got = prereqs.temporal_edges(v, "chapter_id", "first", "concept_id", "embedding", DEFAULTS.temporal_similarity, DEFAULTS.temporal_cap, prereqs.prerequisite_edges(_rels(s, d), _canon(s, d)), "last")
    return got.withColumn("confidence", F.round("confidence", 6))


# Vectors and clusters


@query
def domain_argmax(s: SparkSession, d: str) -> DataFrame:
    v = _vectors(s, d)
    place = F.col("label") % F.lit(len(DOMAINS))
    seeds = v.groupBy(place.alias("place")).agg(F.min_by("embedding", "vec_id").alias("seed_vector")).select(F.element_at(F.array(*map(F.lit, DOMAINS)), F.col("place") + 1).alias("seed"), F.col("place").cast("long").alias("place"), "seed_vector")
    return clusters.nearest_seed(v, "vec_id", "embedding", seeds).select("vec_id", "seed", F.round("similarity", 6).alias("similarity"))


@query
def cluster_min_sim(s: SparkSession, d: str) -> DataFrame:
    got = pairs.least_similarity(_vectors(s, d), "label", "vec_id", "embedding")
    return got.select("label", "n", F.round("least", 6).alias("least"), clusters.triage(F.col("least"), 0.9, -0.45).alias("fate"))


@query
def greedy_keep_first(s: SparkSession, d: str) -> DataFrame:
    return frames.keep_first(_vectors(s, d).withColumn("scope", F.lit(0)), "scope", "vec_id", "embedding", 0.35).select("vec_id", "leader")


@query
def kmeans_representatives(s: SparkSession, d: str) -> DataFrame:
    return frames.representatives(_vectors(s, d), "label", "vec_id", "embedding", 4)


@query
def density_clusters(s: SparkSession, d: str) -> DataFrame:
    return clusters.clustered(_vectors(s, d), "label", "vec_id", "embedding", 3)


@query
def change_boundaries(s: SparkSession, d: str) -> DataFrame:
    return clusters.change_boundaries(_vectors(s, d), "label", "vec_id", "embedding")


# Graph


@query
def topic_difficulty(s: SparkSession, d: str) -> DataFrame:
    return topics.topic_difficulty(_canon(s, d).dropDuplicates(["concept_id"]), ["chapter_id", "domain"])


@query
def topic_clusters(s: SparkSession, d: str) -> DataFrame:
    return topics.topic_clusters(_vectors(s, d), "label", "vec_id", "embedding", 3)


def _live_depths(s, d):
    edges = prereqs.prerequisite_edges(_rels(s, d), _canon(s, d).filter("deleted_at IS NULL"))
    return prereqs.depths(edges)


def _edges(s, d, nodes):
    return graph.graph_edges(nodes, _rels(s, d), _canon(s, d), segments=_segs(s, d).dropDuplicates(["segment_id"]))


_NARROW = ("id", "type", "label", "domain", "chapter_id", "n_evidence")


def _graph(s, d):
    """Nodes and edges, written once with the columns that the views read: they read them several times."""
    scratch = Scratch(s, "graph")
    nodes = scratch.save(graph.graph_nodes(_canon(s, d), _units(s, d)).select(*_NARROW), "nodes")
    return nodes, scratch.save(_edges(s, d, nodes), "edges")


@query
def graph_nodes(s: SparkSession, d: str) -> DataFrame:
    got = graph.graph_nodes(_canon(s, d), _units(s, d), _live_depths(s, d))
    joined = lambda c: F.md5(F.array_join(c, "|"))
    return got.withColumns({"definition": F.md5("definition"), "aliases": joined("aliases"), "evidence": joined("evidence"), "confidence": F.round("confidence", 6)})


@query
def graph_edges(s: SparkSession, d: str) -> DataFrame:
    nodes = graph.graph_nodes(_canon(s, d), _units(s, d)).select("id", "type", "domain", "chapter_id")
    return _edges(s, d, nodes).select("source", "target", "type", F.round("confidence", 6).alias("confidence"), "cross_domain", "chapter_id")


@query
def cross_domain_edges(s: SparkSession, d: str) -> DataFrame:
    """Over raw concepts, whose domains differ within a chapter."""
    raw = _raw(s, d).withColumns({"aliases": F.array().cast("array<string>"), "source_segments": F.array("segment_id"), "deleted_at": F.lit(None).cast("timestamp")})
    nodes = graph.graph_nodes(raw, _units(s, d)).select("id", "type", "domain", "chapter_id")
    return graph.graph_edges(nodes, _rels(s, d), raw).filter("cross_domain").groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query
def quality_gates(s: SparkSession, d: str) -> DataFrame:
    return graph.quality_gates(*_graph(s, d)).withColumn("value", F.round("value", 6))


@query
def induced_overview(s: SparkSession, d: str) -> DataFrame:
    nodes, edges = _graph(s, d)
    return graph.induced(nodes.filter("type in ('Chapter', 'TopicGodNode')"), edges).select("source", "target", "type")


@query
def induced_domain(s: SparkSession, d: str) -> DataFrame:
    nodes, edges = _graph(s, d)
    return graph.induced(nodes.filter("domain = 'mechanics'"), edges).select("source", "target", "type")


@query
def induced_concepts(s: SparkSession, d: str) -> DataFrame:
    nodes, edges = _graph(s, d)
    return graph.induced(nodes.filter("type = 'AtomicConcept'"), edges).select("source", "target", "type")


@query
def requires_view(s: SparkSession, d: str) -> DataFrame:
    nodes, edges = _graph(s, d)
    return graph.induced(nodes.filter("type = 'AtomicConcept'"), edges.filter("type = 'requires'")).select("source", "target")


@query
def export_views(s: SparkSession, d: str) -> DataFrame:
    return graph.export_views(*_graph(s, d))


@query
def domains_present(s: SparkSession, d: str) -> DataFrame:
    return graph.domains_present(graph.graph_nodes(_raw(s, d).withColumns({"aliases": F.array().cast("array<string>"), "source_segments": F.array("segment_id"), "deleted_at": F.lit(None).cast("timestamp")}), _units(s, d)))


@query
def concept_texts(s: SparkSession, d: str) -> DataFrame:
    return graph.concept_texts(graph.graph_nodes(_canon(s, d), _units(s, d))).select("id", F.md5("text").alias("text_md5"))


@query
def graph_summary(s: SparkSession, d: str) -> DataFrame:
    return graph.graph_summary(*_graph(s, d))


@query
def triples(s: SparkSession, d: str) -> DataFrame:
    return graph.triples(*_graph(s, d))


@query
def node_style(s: SparkSession, d: str) -> DataFrame:
    return graph.node_style(graph.graph_nodes(_canon(s, d), _units(s, d), _live_depths(s, d))).withColumn("tooltip", F.md5("tooltip"))


@query
def edge_style(s: SparkSession, d: str) -> DataFrame:
    return graph.edge_style(_graph(s, d)[1]).withColumn("width", F.round("width", 6))


# The whole graph: every spelling of a relation counts, requires edges have no cycles and the temporal ones among them, topics
# are clusters of names. SQL can't break cycles or cluster, so the queries above keep to what it can say.


@query
def dag_edges(s: SparkSession, d: str) -> DataFrame:
    return prereqs.whole_dag(_rels(s, d), _canon(s, d).filter("deleted_at IS NULL"), _segs(s, d))


def _dag_graph(s, d):
    scratch = Scratch(s, "dag-graph")
    members = topics.topic_members(graph.live_concepts(_canon(s, d)), DEFAULTS.min_topic_cluster)
    dag = scratch.save(dag_edges(s, d), "dag")
    nodes = scratch.save(graph.graph_nodes(_canon(s, d), _units(s, d), prereqs.depths(dag), members), "nodes")
    edges = graph.graph_edges(nodes, prereqs.plain_relations(_rels(s, d)), _canon(s, d), dag, members, _segs(s, d).dropDuplicates(["segment_id"]))
    return nodes, scratch.save(edges, "edges")


@query
def dag_graph_nodes(s: SparkSession, d: str) -> DataFrame:
    return _dag_graph(s, d)[0].select("id", "type", "label", "domain", "chapter_id", "frequency", "n_evidence", "concept_type", "difficulty", "depth_level")


@query
def dag_graph_edges(s: SparkSession, d: str) -> DataFrame:
    return _dag_graph(s, d)[1].select("source", "target", "type", F.round("confidence", 6).alias("confidence"), "cross_domain", "chapter_id")


@query
def dag_requires_view(s: SparkSession, d: str) -> DataFrame:
    nodes, edges = _dag_graph(s, d)
    return graph.induced(nodes.filter("type = 'AtomicConcept'"), edges.filter("type = 'requires'")).select("source", "target")


@query
def dag_triples(s: SparkSession, d: str) -> DataFrame:
    return graph.triples(*_dag_graph(s, d))


@query
def dag_quality_gates(s: SparkSession, d: str) -> DataFrame:
    return graph.quality_gates(*_dag_graph(s, d)).withColumn("value", F.round("value", 6))
