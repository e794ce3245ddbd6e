"""Interfaces to outside models: speech, vision, embeddings, language models.

The engine has no models. A call-out is an adapter, a function on Arrow-batched frames that the caller supplies; recorded
replies can stand in for one. Without either a call-out is refused, never faked.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conceptloom.functions.text import think_stripped

Adapter = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


class NotConfigured(RuntimeError):
    """A stage needs a model that was not supplied."""


def call_out(rows: DataFrame, adapter: Adapter | None, schema: str) -> DataFrame:
    """Rows through a model; the adapter loads it once per task, before its first batch."""
    if adapter is None:
        raise NotConfigured("no adapter was given for this model stage")
    return rows.mapInPandas(adapter, schema)


def recorded(rows: DataFrame, replies: DataFrame, key: str, reply: str = "reply") -> DataFrame:
    """Rows with the replies that were recorded for their keys; rows without one stay, with a null reply."""
    return rows.join(replies.groupBy(key).agg(F.min(reply).alias(reply)), key, "left")


def pending(rows: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """Rows for which no reply is recorded."""
    return rows.join(replies.select(key).distinct(), key, "left_anti")


def decided(clusters: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """(key, merge): yes or no of a decider for each cluster, without its <think> block; a missing or unreadable reply, like
    anything that doesn't begin with yes, keeps the members apart."""
    said = F.lower(think_stripped(F.coalesce("reply", F.lit(""))))
    return recorded(clusters.select(key).distinct(), replies, key).select(key, F.startswith(said, F.lit("yes")).alias("merge"))


def prompt(template: str, **columns: Column) -> Column:
    """A template with {name} marks filled from columns; a null gives an empty text, an unknown mark is an error."""
    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        parts += [F.lit(literal)] if literal else []
        if name is not None:
            parts.append(F.coalesce(columns[name].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def language_of(label: Column, default: str = "en") -> Column:
    """A language label in lower case, cut before the first - or _; without one the default."""
    return F.coalesce(F.nullif(F.regexp_extract(F.lower(F.trim(label)), "^([^-_]*)", 1), F.lit("")), F.lit(default))


def embedder_for(language: Column, english: str, other: str) -> Column:
    """Which of two embedding models a text takes."""
    return F.when(language == "en", english).otherwise(other)


def probed(videos: DataFrame, adapter: Adapter | None) -> DataFrame:
    """(path, duration, subtype) of videos (path) by a probe; one that fails gives no row, and its unit keeps the defaults."""
    return call_out(videos.select("path"), adapter, "path string, duration double, subtype string")


def image_vectors(frames: DataFrame, adapter: Adapter | None, size: int = 512) -> DataFrame:
    """(frame_path, embedding) by an image model; a frame for which it has none gets zeros, so that it stays in its video."""
    made = call_out(frames.select("frame_path").distinct(), adapter, "frame_path string, embedding array<float>").dropDuplicates(["frame_path"])
    return frames.select("frame_path").distinct().join(made, "frame_path", "left").select("frame_path", F.coalesce("embedding", F.array_repeat(F.lit(0.0), size).cast("array<float>")).alias("embedding"))


def with_transcripts(units: DataFrame, texts: DataFrame) -> DataFrame:
    """Units with the texts (unit_id, text) of a speech model, or of sibling files, as raw_text of videos; other units, and videos
    without a text, stay as they are."""
    one = texts.groupBy("unit_id").agg(F.min("text").alias("__text"))
    new = F.when(F.col("source_type") == "video", F.coalesce("__text", "raw_text")).otherwise(F.col("raw_text"))
    return units.join(one, "unit_id", "left").withColumn("raw_text", new).select(units.columns)


def hashed_embedding(text: Column, size: int = 64) -> Column:
    """A unit vector of hashed words, the default where no embedder is supplied; a text without words gives zeros.

    A word counts at place h mod size, where h are the first 32 bits of its MD5; up if h's highest bit is set, else down.
    """

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pd.Series) -> pd.Series:
        out = np.zeros((len(texts), size))
        known: dict[str, tuple[int, float]] = {}
        for i, text in enumerate(texts):
            for w in (text or "").lower().split():
                if w not in known:
                    h = int.from_bytes(hashlib.md5(w.encode("utf-8", "replace")).digest()[:4], "big")
                    known[w] = h % size, 1.0 if h & 0x80000000 else -1.0
                at, sign = known[w]
                out[i, at] += sign
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return pd.Series(list((out / np.where(n > 0, n, 1)).astype(np.float32)))

    return embed(text)
