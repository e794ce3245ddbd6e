"""Readers that turn files of teaching material into evidence units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conceptloom.config import EXTENSIONS
from conceptloom.functions.text import path_name, path_stem, path_suffix, strip_white, words
from conceptloom.operators.ordered import running_counts
from conceptloom.runtime import Scratch

UNIT = (
    "unit_id string, source_path string, source_type string, video_subtype string, chapter_id string, span_start double, span_end double, "
    "raw_text string, visual_caption string, ocr_text string, keyframe_paths array<string>, domain string, confidence double, unit_seq long"
)


def stable_id(*parts: Column) -> Column:
    """An id from the content, the same after every retry."""
    return F.sha2(F.concat_ws("\x01", *parts), 256)


def source_kind(path: Column) -> Column:
    suffix, out = path_suffix(path), None
    for kind, endings in EXTENSIONS.items():
        out = F.when(suffix.isin(endings), kind) if out is None else out.when(suffix.isin(endings), kind)
    return out.otherwise("skip")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, suffix, kind, length, modified) of the non-empty files in a folder, without their content."""
    rows = spark.read.format("binaryFile").load(folder)
    return rows.select("path", path_name("path").alias("name"), path_suffix("path").alias("suffix"), source_kind(F.col("path")).alias("kind"), "length", F.col("modificationTime").alias("modified"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSONL file; malformed lines come with their text in _corrupt, so that they can be counted, blank lines not at all."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").option("mode", "PERMISSIVE").json(path)


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON document, or none of that schema if there is no such file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def _unit(df: DataFrame, kind: str, chapter: str, start: Column, stop: Column, text: Column, ordinal: Column, confidence: float = 1.0) -> DataFrame:
    return df.select(
        stable_id(F.lit(chapter), F.col("path"), ordinal.cast("string")).alias("unit_id"),
        F.col("path").alias("source_path"),
        F.lit(kind).alias("source_type"),
        F.lit("null").alias("video_subtype"),
        F.lit(chapter).alias("chapter_id"),
        start.cast("double").alias("span_start"),
        stop.cast("double").alias("span_end"),
        text.alias("raw_text"),
        F.lit("").alias("visual_caption"),
        F.lit("").alias("ocr_text"),
        F.array().cast("array<string>").alias("keyframe_paths"),
        F.lit("").alias("domain"),
        F.lit(confidence).alias("confidence"),
        ordinal.cast("long").alias("unit_seq"),
    )


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of files read whole."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def text_units(spark: SparkSession, path: str, chapter: str) -> DataFrame:
    return text_units_of(whole_texts(spark, path), chapter)


def text_units_of(texts: DataFrame, chapter: str) -> DataFrame:
    """One unit per text (path, text); the ordinal counts blank ones too, which give no unit."""
    rows = numbered(texts, "path")
    return _unit(rows.filter(strip_white("text") != ""), "text", chapter, F.col("n"), F.col("n"), F.col("text"), F.col("n"))


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """n along the order (total; null first), in parallel: rows are spread by range, and the range that each row came to is
    written down once; what is counted afterwards depends on the written numbers alone, never on how a later plan is cut."""
    spread = rows.repartitionByRange(F.col(order).asc_nulls_first()).withColumn("__p", F.spark_partition_id().cast("long"))
    saved = Scratch(rows.sparkSession, "numbered").save(spread, "ranges")
    return running_counts(saved.withColumn("__q", F.lit(0)), ["__q"], ["__p", order], F.col("__p")).drop("__p", "__q", "flags", "since")


_CUE = r"(?s)(?:(\d+):)?(\d+):(\d+)[.,](\d+)\s*-->\s*(?:(\d+):)?(\d+):(\d+)[.,](\d+)[^\n]*\n(.*)"


def cues(text: Column) -> Column:
    """Cues of an SRT or VTT text: array of (start, stop, text) of its non-blank blocks."""
    block = F.split(F.regexp_replace(text, r"\r\n?", "\n"), r"\n[ \t]*\n")

    def seconds(b: Column, i: int) -> Column:
        part = lambda k: F.coalesce(F.nullif(F.regexp_extract(b, _CUE, k), F.lit("")).cast("double"), F.lit(0.0))
        return part(i) * 3600 + part(i + 1) * 60 + part(i + 2) + F.concat(F.lit("0."), F.coalesce(F.nullif(F.regexp_extract(b, _CUE, i + 3), F.lit("")), F.lit("0"))).cast("double")

    made = F.transform(F.filter(block, lambda b: b.rlike(_CUE)), lambda b: F.struct(seconds(b, 1).alias("start"), seconds(b, 5).alias("stop"), strip_white(F.regexp_extract(b, _CUE, 9)).alias("text")))
    return F.filter(made, lambda c: c.text != "")


def cue_units(spark: SparkSession, path: str, chapter: str) -> DataFrame:
    return cue_units_of(whole_texts(spark, path), chapter)


def cue_units_of(texts: DataFrame, chapter: str) -> DataFrame:
    """One unit per non-blank cue of SRT and VTT texts (path, text)."""
    rows = texts.select("path", F.posexplode(cues(F.col("text"))).alias("n", "c"))
    return _unit(rows, "text", chapter, F.col("c.start"), F.col("c.stop"), F.col("c.text"), F.col("n"))


def question_units(spark: SparkSession, path: str, chapter: str) -> DataFrame:
    return question_units_of(whole_texts(spark, path), chapter)


def question_units_of(texts: DataFrame, chapter: str) -> DataFrame:
    """Question-bank JSON (path, text): one unit per item, confidence 0.95; items without question or answer give none."""
    bank = F.from_json("text", "items array<struct<question string, answer string, wrong array<string>>>")
    rows = texts.select("path", F.posexplode(bank["items"]).alias("n", "i")).filter("i.question is not null and i.answer is not null")
    wrong = F.when(F.size("i.wrong") > 0, F.concat(F.lit("Wrong: "), F.array_join("i.wrong", ", "))).otherwise("")
    return _unit(rows, "json", chapter, F.col("n"), F.col("n"), question_text(F.col("i.question"), F.col("i.answer"), wrong), F.col("n"), 0.95)


def question_text(question: Column, answer: Column, wrong: Column) -> Column:
    return F.concat(F.lit("Q: "), question, F.lit("\nA: "), answer, F.lit("\n"), wrong)


def transcript_units(spark: SparkSession, path: str, chapter: str) -> DataFrame:
    return transcript_units_of(whole_texts(spark, path), chapter)


def transcript_units_of(texts: DataFrame, chapter: str) -> DataFrame:
    """Transcript JSON (path, text: segments of start, end, text): one text unit per item."""
    spoken = F.from_json("text", "segments array<struct<start double, `end` double, text string>>")
    rows = texts.select("path", F.posexplode(spoken["segments"]).alias("n", "i"))
    return _unit(rows, "text", chapter, F.col("i.start"), F.col("i.end"), F.coalesce("i.text", F.lit("")), F.col("n"))


def unknown_json_units(spark: SparkSession, path: str, chapter: str, most: int = 4000) -> DataFrame:
    return unknown_json_units_of(whole_texts(spark, path), chapter, most)


def unknown_json_units_of(texts: DataFrame, chapter: str, most: int = 4000) -> DataFrame:
    """JSON of an unknown shape (path, text): one unit with the document's first characters, its span the number of its items (an
    object is one item); unparsable documents give '[]' and no items."""
    whole = F.coalesce(F.to_json(F.try_variant_get(F.try_parse_json("text"), "$", "variant")), F.lit("[]"))
    items = F.coalesce(F.json_array_length(whole), F.when(whole != "[]", 1), F.lit(0))
    return _unit(texts, "json", chapter, F.lit(0), items, F.substring(whole, 1, most), F.lit(0))


def media_units(listed: DataFrame, kind: str, chapter: str, probed: DataFrame | None = None) -> DataFrame:
    """One unit per image or video file, without text. A video's span is its duration and its subtype what a probe (path, duration,
    subtype) said; one that could not be probed has duration 0 and subtype 'unknown', and is a unit all the same."""
    rows = listed.filter(F.col("kind") == kind)
    if probed is not None:
        rows = rows.join(probed.groupBy("path").agg(F.max("duration").alias("duration"), F.max("subtype").alias("subtype")), "path", "left")
    stop = F.col("duration") if "duration" in rows.columns else F.lit(0.0)
    out = _unit(rows, kind, chapter, F.lit(0.0), F.coalesce(stop, F.lit(0.0)), F.lit(""), F.lit(0))
    if kind != "video":
        return out
    said = rows.select(F.col("path").alias("source_path"), (F.col("subtype") if "subtype" in rows.columns else F.lit(None).cast("string")).alias("__said"))
    return out.join(said, "source_path").withColumn("video_subtype", F.coalesce("__said", F.lit("unknown"))).select(out.columns)


def page_kind(text: Column, has_image: Column, least_words: int = 20) -> Column:
    """text, visual or sparse: a page with enough words, one without them but with an image, and the rest."""
    n = F.coalesce(F.size(words(text)), F.lit(0))
    return F.when(n >= least_words, "text").when(has_image, "visual").otherwise("sparse")


def page_units(pages: DataFrame, chapter: str, least_words: int = 20, size: int = 3) -> DataFrame:
    """Units of pages (path, page, text, image): text pages in chunks of ``size`` over text pages alone, their span the first and last
    page; a visual page as a unit without text and with its image; sparse pages give none."""
    kinds = pages.withColumn("kind", page_kind(F.col("text"), F.coalesce(F.col("image") != "", F.lit(False)), least_words))
    texts = page_chunks(kinds.filter("kind = 'text'"), "path", "page", "text", size)
    made = _unit(texts, "pdf", chapter, F.col("first_page"), F.col("last_page"), F.col("chunk_text"), F.col("first_page"))
    seen = kinds.filter("kind = 'visual'")
    shown = _unit(seen, "pdf", chapter, F.col("page"), F.col("page"), F.lit(""), F.col("page"))
    images = seen.select(F.col("path").alias("source_path"), F.col("page").cast("long").alias("unit_seq"), F.array("image").alias("__k"))
    return made.unionByName(shown.join(images, ["source_path", "unit_seq"]).withColumn("keyframe_paths", F.col("__k")).select(made.columns))


def visual_pages(units: DataFrame) -> DataFrame:
    """Page units that are to be described by their image: those without text."""
    return units.filter((F.col("source_type") == "pdf") & (F.coalesce("raw_text", F.lit("")) == ""))


def encoded_images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, data): files as base64 texts, as models take them."""
    return spark.read.format("binaryFile").load(folder).select("path", F.base64("content").alias("data"))


def page_chunks(pages: DataFrame, source: str, page: str, text: str, size: int = 3) -> DataFrame:
    """(source, chunk, first_page, last_page, chunk_text): text pages in order, ``size`` to a chunk; pages without text are none."""
    rows = pages.filter(strip_white(text) != "").withColumn("__c", F.floor((F.row_number().over(Window.partitionBy(source).orderBy(page)) - 1) / F.lit(size)))
    listed = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t"))))
    return rows.groupBy(source, F.col("__c").alias("chunk")).agg(F.min(page).alias("first_page"), F.max(page).alias("last_page"), F.array_join(F.transform(listed, lambda x: x.t), "\n\n").alias("chunk_text"))


def sibling_transcripts(listed: DataFrame) -> DataFrame:
    """(video, transcript): the transcript beside each video with the same stem, .srt before .vtt before .txt; null if none."""
    rows = listed.select("path", "suffix", "kind", path_stem("path").alias("stem"), F.regexp_replace("path", r"[^/]*$", "").alias("dir"))
    place = F.when(F.col("suffix") == ".srt", 0).when(F.col("suffix") == ".vtt", 1).when(F.col("suffix") == ".txt", 2)
    beside = rows.withColumn("place", place).dropna(subset=["place"]).select("dir", "stem", F.col("path").alias("transcript"), "place")
    rank = F.row_number().over(Window.partitionBy("video").orderBy(F.asc_nulls_last("place"), "transcript"))
    met = rows.filter("kind = 'video'").select("dir", "stem", F.col("path").alias("video")).join(beside, ["dir", "stem"], "left")
    return met.withColumn("r", rank).filter("r = 1").select("video", "transcript")


def first_table(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of several tables that exists: a stage's newest output, else an earlier stage's."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return spark.read.parquet(path)
    raise FileNotFoundError(", ".join(paths))


def selected_path(folder: str, video: Column, frame: Column) -> Column:
    """Where a selected frame is copied to: below its video, so that frames of equal names don't collide."""
    return F.concat_ws("/", F.lit(folder.rstrip("/")), F.regexp_replace(video, r"^/+|\.[^./]*$", ""), path_name(frame))
