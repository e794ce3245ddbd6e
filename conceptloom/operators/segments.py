"""Evidence units to segments: contexts, boundaries, capped sessions, rollup, splitting and validation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptloom.adapters import hashed_embedding
from conceptloom.config import DEFAULTS, EngineConfig
from conceptloom.functions.text import strip_white, words
from conceptloom.functions.vectors import dot
from conceptloom.operators.clusters import change_boundaries, nearest_seed
from conceptloom.operators.ordered import running_counts, with_previous
from conceptloom.runtime import Scratch


def _chunk(seq: str, config: EngineConfig) -> Column:
    return F.floor(F.col(seq) / F.lit(config.chunk_rows))


def merged_context(units: DataFrame) -> DataFrame:
    """unit_id and context: the non-empty ones of raw text, caption and recognised text, joined by a space, stripped."""
    parts = [F.nullif(F.col(c), F.lit("")) for c in ("raw_text", "visual_caption", "ocr_text")]
    return units.select("unit_id", strip_white(F.concat_ws(" ", *parts)).alias("context"))


def source_boundaries(units: DataFrame, config: EngineConfig = DEFAULTS) -> DataFrame:
    """Units (one row per unit_id) with boundary: whether the source differs from the unit before in the chapter."""
    rows = with_previous(units.dropDuplicates(["unit_id"]), ["chapter_id"], ["unit_seq", "unit_id"], _chunk("unit_seq", config), {"previous_source": "source_path", "previous_id": "unit_id"})
    return rows.withColumn("boundary", F.col("previous_id").isNotNull() & ~F.col("previous_source").eqNullSafe(F.col("source_path")))


def similarity_boundaries(vectors: DataFrame, key: str, seq: str, vector: str, threshold: float) -> DataFrame:
    """(key, seq, similarity) of rows whose vector's dot product with that of the row before is below the threshold."""
    rows = with_previous(vectors.select(key, seq, vector), [key], [seq], F.floor(F.col(seq) / F.lit(1024)), {"previous": vector})
    return rows.select(key, seq, dot("previous", vector).alias("similarity")).filter(F.col("similarity") < threshold)


def duration_boundaries(units: DataFrame, config: EngineConfig = DEFAULTS) -> DataFrame:
    return units.filter(F.col("span_end") - F.col("span_start") > config.segment_max_seconds).select("unit_id")


def capped_sessions(rows: DataFrame, keys: list[str], order: list[str], boundary: Column, chunk: Column, cap: int) -> DataFrame:
    """Add session, part: a new session at each boundary, cut into parts of at most ``cap`` rows."""
    counted = running_counts(rows, keys, order, chunk, boundary)
    return counted.withColumnRenamed("flags", "session").withColumn("part", F.floor(F.col("since") / F.lit(cap))).drop("since", "n")


def context_vectors(units: DataFrame) -> DataFrame:
    """(unit_id, embedding) of the contexts by the default embedder; an empty context counts as "no content"."""
    return merged_context(units).select("unit_id", hashed_embedding(F.coalesce(F.nullif("context", F.lit("")), F.lit("no content"))).alias("embedding"))


def all_boundaries(units: DataFrame, config: EngineConfig = DEFAULTS, vectors: DataFrame | None = None) -> DataFrame:
    """Units (one row per unit_id) with boundary: a new source, a vector unlike the one before (dot product, rounded to six
    digits, below similarity_boundary), or a unit longer than segment_max_seconds. The first unit of a chapter opens none.

    Vectors are (unit_id, embedding), by default those of the contexts; a unit without one is unlike none. One pass along
    the order in chunks finds source and similarity boundaries together.
    """
    rows = units.dropDuplicates(["unit_id"])
    if vectors is None:
        context = strip_white(F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in ("raw_text", "visual_caption", "ocr_text")]))
        rows = rows.withColumn("__vector", hashed_embedding(F.coalesce(F.nullif(context, F.lit("")), F.lit("no content"))))
    else:
        rows = rows.join(vectors.select("unit_id", F.col("embedding").alias("__vector")).dropDuplicates(["unit_id"]), "unit_id", "left")
    rows = with_previous(rows, ["chapter_id"], ["unit_seq", "unit_id"], _chunk("unit_seq", config), {"previous_source": "source_path", "previous_id": "unit_id", "__before": "__vector"})
    unlike = F.round(dot("__before", "__vector"), 6) < config.similarity_boundary
    long = F.col("span_end") - F.col("span_start") > config.segment_max_seconds
    any_ = ~F.col("previous_source").eqNullSafe(F.col("source_path")) | F.coalesce(unlike, F.lit(False)) | F.coalesce(long, F.lit(False))
    return rows.withColumn("boundary", F.col("previous_id").isNotNull() & any_).drop("__vector", "__before")


def segments(units: DataFrame, config: EngineConfig = DEFAULTS, vectors: DataFrame | None = None) -> DataFrame:
    """Units with chapter_id, session, part: sessions between the boundaries of ``all_boundaries``, at most segment_max_units
    units each."""
    return capped_sessions(all_boundaries(units, config, vectors), ["chapter_id"], ["unit_seq", "unit_id"], F.col("boundary"), _chunk("unit_seq", config), config.segment_max_units)


def topic_segments(units: DataFrame, config: EngineConfig = DEFAULTS, vectors: DataFrame | None = None) -> DataFrame:
    """Units with chapter_id, session, part as of ``segments``, but a session also ends at change points of the vectors."""
    order = ["unit_seq", "unit_id"]
    scratch = Scratch(units.sparkSession, "segments")
    rows = running_counts(all_boundaries(units, config, vectors), ["chapter_id"], order, _chunk("unit_seq", config)).withColumnRenamed("n", "place").drop("flags", "since")
    rows = scratch.save(rows, "rows")
    if vectors is None:
        vectors = context_vectors(rows)
    placed = rows.select("chapter_id", "unit_id", "place").join(vectors.select("unit_id", "embedding").dropDuplicates(["unit_id"]), "unit_id").select("chapter_id", "place", "embedding")
    changes = change_boundaries(placed, "chapter_id", "place", "embedding").withColumn("change", F.lit(True))
    rows = rows.join(changes, ["chapter_id", "place"], "left")
    rows = rows.withColumn("boundary", F.col("boundary") | ((F.col("place") > 0) & F.coalesce("change", F.lit(False)))).drop("change", "place")
    return capped_sessions(rows, ["chapter_id"], order, F.col("boundary"), _chunk("unit_seq", config), config.segment_max_units)


def segment_rollup(units: DataFrame, config: EngineConfig = DEFAULTS, by: Callable[..., DataFrame] = segments) -> DataFrame:
    """One row per segment: span, count, ordered distinct sources and types, the first keyframes of its video units, and the
    contexts in order.

    A segment has at most segment_max_units units, so the collected lists are bounded.
    """
    rows = by(units, config).withColumn("context", strip_white(F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in ("raw_text", "visual_caption", "ocr_text")])))
    inorder = F.array_sort(F.collect_list(F.struct("unit_seq", "unit_id", "source_path", "source_type", "context", F.slice(F.array_distinct("keyframe_paths"), 1, config.keyframes).alias("k"))))
    grouped = rows.groupBy("chapter_id", "session", "part").agg(
        F.min("span_start").alias("span_start"), F.max("span_end").alias("span_end"), F.count(F.lit(1)).alias("unit_count"), inorder.alias("u")
    )
    return grouped.select(
        "chapter_id",
        "session",
        "part",
        "span_start",
        "span_end",
        "unit_count",
        F.array_join("u.unit_id", ",").alias("unit_ids"),
        F.array_join(F.array_distinct("u.source_path"), ",").alias("source_paths"),
        F.array_join(F.array_distinct("u.source_type"), ",").alias("source_types"),
        F.array_join(F.filter("u.context", lambda c: c != ""), " ").alias("merged_text"),
        F.array_join(F.slice(F.array_distinct(F.flatten(F.transform(F.filter("u", lambda x: x.source_type == "video"), lambda x: F.coalesce(x.k, F.array().cast("array<string>"))))), 1, config.keyframes), ",").alias("keyframes"),
    )


def with_domains(segs: DataFrame, key: str, text: str, seeds: DataFrame, config: EngineConfig = DEFAULTS) -> DataFrame:
    """(key, domain, domain_confidence, needs_llm_domain_check): the domain whose seed (seed, place, seed_vector) is most
    similar to the text's vector; below domain_confidence it should be checked."""
    vectors = segs.select(key, hashed_embedding(F.coalesce(F.col(text), F.lit(""))).alias("__e"))
    got = nearest_seed(vectors, key, "__e", seeds)
    sure = F.round("similarity", 4)
    return got.select(key, F.col("seed").alias("domain"), sure.alias("domain_confidence"), (sure < config.domain_confidence).alias("needs_llm_domain_check"))


def domain_seeds(spark, domains: dict[str, str]) -> DataFrame:
    """(seed, place, seed_vector) from a phrase for each domain."""
    rows = spark.createDataFrame([(d, i, phrase) for i, (d, phrase) in enumerate(domains.items())], "seed string, place long, phrase string")
    return rows.select("seed", "place", hashed_embedding(F.col("phrase")).alias("seed_vector"))


def split_long(units: DataFrame, longest: float, min_words: int) -> DataFrame:
    """Slices of units (unit_id, span_start, span_end, text) whose span is longer than ``longest``.

    floor(duration / longest) + 1 slices of equal time; each takes max(min_words, words // slices) words, the last the
    rest; slices without words are left out.
    """
    rows = units.filter(F.col("span_end") - F.col("span_start") > longest).select(
        "unit_id", "span_start", (F.col("span_end") - F.col("span_start")).alias("duration"), words("text").alias("w")
    )
    rows = rows.withColumn("slices", F.floor(F.col("duration") / F.lit(longest)).cast("int") + 1)
    rows = rows.withColumn("per", F.greatest(F.lit(min_words), F.floor(F.size("w") / F.col("slices")).cast("int")))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    step = F.col("duration") / F.col("slices")
    part = F.when(F.col("k") < F.col("slices") - 1, F.slice("w", F.col("k") * F.col("per") + 1, F.col("per"))).otherwise(
        F.slice("w", F.col("k") * F.col("per") + 1, F.greatest(F.size("w"), F.lit(1)))
    )
    return (
        rows.select("unit_id", "k", (F.col("span_start") + F.col("k") * step).alias("slice_start"), (F.col("span_start") + (F.col("k") + 1) * step).alias("slice_end"), part.alias("p"))
        .filter(F.size("p") > 0)
        .select("unit_id", F.col("k").cast("long").alias("k"), "slice_start", "slice_end", F.array_join("p", " ").alias("slice_text"))
    )


def segment_reason(text: str = "merged_text", domain: str = "domain", config: EngineConfig = DEFAULTS) -> Column:
    """Why a segment is dropped, or 'ok'; the order of tests defines the reason."""
    n = F.coalesce(F.size(words(text)), F.lit(0))
    return (
        F.when(n < config.segment_min_words, "too_short")
        .when(n > 2 * config.segment_max_words, "too_long")
        .when(F.coalesce(F.col(domain), F.lit("")) == "", "no_domain")
        .when(strip_white(text) == "", "blank")
        .otherwise("ok")
    )


def valid_segments(segs: DataFrame, config: EngineConfig = DEFAULTS) -> DataFrame:
    """(segment_id, n_words, reason) of each segment."""
    return segs.dropDuplicates(["segment_id"]).select("segment_id", F.coalesce(F.size(words("merged_text")), F.lit(0)).cast("long").alias("n_words"), segment_reason(config=config).alias("reason"))


def first_words(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    return df.select(key, F.array_join(F.slice(words(text), 1, n), " ").alias("head"))


#: Length of the shortest class of intervals, in seconds.
SHORTEST = 8.0


def overlapping(spans: DataFrame, cues: DataFrame) -> DataFrame:
    """Pairs of spans and cues (entity, start, stop, ...) of one entity whose closed intervals meet, with the other columns of
    both (their names must differ); a span (0, 0) takes all cues. Ends that are null, NaN or beyond 1e15 seconds meet nothing.

    An interval join on cells: an interval's class is the smallest width SHORTEST * 2^k that it fits in, so it covers at most
    two cells of that width or a larger one. Each looks into its cells of its own class and of the larger ones in use; a pair
    is compared in one place, at the class of the longer one and in the later of the two first cells. Cells split a hot
    entity, and only what shares a cell is compared.
    """
    width = lambda k: F.lit(SHORTEST) * F.pow(F.lit(2.0), k)
    low, high = F.least("start", "stop").cast("double"), F.greatest("start", "stop").cast("double")
    sized = lambda c: F.coalesce(F.abs(F.col(c).cast("double")) < F.lit(1e15), F.lit(False))
    finite = sized("start") & sized("stop")
    extra = lambda df: [c for c in df.columns if c not in ("entity", "start", "stop")]
    scratch = Scratch(spans.sparkSession, "overlap")

    def classed(df: DataFrame, name: str) -> DataFrame:
        class_ = F.ceil(F.log2(F.greatest(high - low, F.lit(SHORTEST)) / F.lit(SHORTEST))).cast("int")
        return scratch.save(df.filter(finite).withColumn("__class", class_), name)

    every = F.coalesce((F.col("start") == 0) & (F.col("stop") == 0), F.lit(False))
    some, cued = classed(spans.filter(~every), "spans"), classed(cues, "cues")
    classes = [r[0] for r in some.select("__class").union(cued.select("__class")).distinct().collect()]  # at most one for each power of two

    def celled(df: DataFrame, tag: str) -> DataFrame:
        rows = df.withColumn("__k", F.explode(F.array(*map(F.lit, classes)).cast("array<int>"))).filter(F.col("__k") >= F.col("__class"))
        rows = rows.withColumn("__first", F.floor(low / width(F.col("__k")))).withColumn("__cell", F.explode(F.sequence("__first", F.floor(high / width(F.col("__k"))))))
        return rows.withColumnsRenamed({c: f"{tag}{c}" for c in ("start", "stop", "__class", "__first")})

    met = celled(some, "s_").join(celled(cued, "c_"), ["entity", "__k", "__cell"]).filter(
        (F.col("__k") == F.greatest("s___class", "c___class")) & (F.col("__cell") == F.greatest("s___first", "c___first")) & (F.col("c_stop") >= F.col("s_start")) & (F.col("c_start") <= F.col("s_stop"))
    )
    whole = spans.filter(every).drop("start", "stop").join(cues, "entity")
    return met.select(*extra(spans), *extra(cues)).unionByName(whole.select(*extra(spans), *extra(cues)))


def transcript_texts(units: DataFrame, cues: DataFrame) -> DataFrame:
    """(unit_id, text): the texts (text) of the cues (entity, start, stop, place) that meet a unit's span (unit_id, entity, start,
    stop), in order of place, joined by spaces; if none meet it, the texts of all cues of its entity; null without any."""
    listed = lambda df, key: df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("l")).select(key, F.array_join(F.filter(F.transform("l", lambda x: strip_white(x.text)), lambda t: t != ""), " ").alias("t"))
    one = units.dropDuplicates(["unit_id"])
    met = listed(overlapping(one.select("unit_id", "entity", "start", "stop"), cues.select("entity", "start", "stop", "place", "text")), "unit_id").withColumnRenamed("t", "some")
    rest = one.select("unit_id", "entity").join(met, "unit_id", "left")
    whole = listed(cues.join(rest.filter(F.col("some").isNull()).select("entity").distinct(), "entity", "left_semi"), "entity").withColumnRenamed("t", "whole")
    return rest.join(whole, "entity", "left").select("unit_id", F.coalesce("some", "whole").alias("text"))


def aligned_keyframes(segs: DataFrame, frames: DataFrame, most: int = DEFAULTS.keyframes) -> DataFrame:
    """(segment_id, n_frames, keyframes): frames of a segment's units within its span, the first ``most`` by time."""
    unit = segs.dropDuplicates(["segment_id"]).select("segment_id", "span_start", "span_end", F.explode(F.array_distinct("unit_ids")).alias("unit_id"))
    frame = frames.dropDuplicates(["frame_path"]).select("unit_id", "timestamp_sec", "frame_path")
    met = unit.join(frame, "unit_id").filter(F.col("timestamp_sec").between(F.col("span_start"), F.col("span_end")))
    # Only the first frames of each segment are collected: ranks cut before the shuffle.
    rank = F.row_number().over(Window.partitionBy("segment_id").orderBy("timestamp_sec", "frame_path"))
    first = met.withColumn("r", rank).filter(F.col("r") <= most)
    listed = first.groupBy("segment_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "frame_path"))), lambda x: x.frame_path), ",").alias("keyframes"))
    return met.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n_frames")).join(listed, "segment_id")


def with_captions(units: DataFrame, captions: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """(unit_id, visual_caption): a unit's new captions (unit_id, place, caption) in order, one a line, all of them; without any
    the old caption, or an empty one. With frames (unit_id, n, paths) also keyframes: the paths of a video unit's frames,
    without any, and for other units, those that it had. The text of a unit is its value and as large as its captions.
    """
    listed = captions.filter(F.coalesce("caption", F.lit("")) != "").groupBy("unit_id").agg(F.array_sort(F.collect_list(F.struct("place", "caption"))).alias("c"))
    joined = listed.select("unit_id", F.array_join(F.transform("c", lambda x: x.caption), "\n").alias("new"))
    out = units.dropDuplicates(["unit_id"]).join(joined, "unit_id", "left")
    caption = F.coalesce("new", "visual_caption", F.lit("")).alias("visual_caption")
    if frames is None:
        return out.select("unit_id", caption)
    own = F.when(F.col("source_type") == "video", F.col("paths"))
    return out.join(frames.select("unit_id", "paths"), "unit_id", "left").select("unit_id", caption, F.coalesce(own, F.array_join("keyframe_paths", ","), F.lit("")).alias("keyframes"))


def whole_sentences(df: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """(key, chunk): the first sentences of a text that together have at most ``most`` words; if not even one has, the first
    6 * most characters."""
    parts = F.regexp_extract_all(text, F.lit(r"[^.!?]*[.!?]+\s*|[^.!?]+$"), F.lit(0))
    start = F.struct(F.lit("").alias("t"), F.lit(0).alias("n"), F.lit(False).alias("full"))

    def step(acc: Column, s: Column) -> Column:
        n = acc["n"] + F.size(words(s))
        full = acc["full"] | (n > most)
        return F.struct(F.when(full, acc["t"]).otherwise(F.concat(acc["t"], s)).alias("t"), F.when(full, acc["n"]).otherwise(n).alias("n"), full.alias("full"))

    got = F.aggregate(parts, start, step)["t"]
    return df.select(key, F.when(got != "", strip_white(got)).otherwise(F.substring(text, 1, 6 * most)).alias("chunk"))
