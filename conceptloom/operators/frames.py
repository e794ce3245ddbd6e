"""Selecting frames: timestamps, quality cascade, greedy deduplication, clusters and representatives, on feature rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptloom.functions.vectors import distance, unit
from conceptloom.operators.ordered import running_counts
from conceptloom.operators.pairs import similar_pairs
from conceptloom.operators.resolve import leaders
from conceptloom.runtime import Scratch


def frame_times(frames: DataFrame, fps: float = 1.0) -> DataFrame:
    """(video_path, frame_path, number, at): frames of each video numbered by path from 0, at number / fps seconds."""
    rows = frames.select("video_path", "frame_path", "frame_num").dropDuplicates(["frame_path"])
    counted = running_counts(rows, ["video_path"], ["frame_num", "frame_path"], F.floor(F.coalesce("frame_num", F.lit(0)) / F.lit(4096)))
    return counted.select("video_path", "frame_path", F.col("n").alias("number"), (F.col("n") / F.lit(fps)).alias("at"))


def quality_reason(mean: Column, sharpness: Column, face_share: Column, dark: float, blur: float, text: float, faces: float) -> Column:
    """Why a frame is dropped, or 'keep'; a frame whose features could not be computed is kept."""
    return (
        F.when(mean.isNull() | sharpness.isNull(), "keep")
        .when(mean < dark, "dark")
        .when(sharpness < blur, "blurred")
        .when((sharpness < text) & (face_share > faces), "face")
        .otherwise("keep")
    )


def densest_frames(frames: DataFrame, most: int) -> DataFrame:
    """The ``most`` frames of highest text density of each video; videos with no more than that keep all (null and NaN last)."""
    density = F.coalesce(F.nanvl("text_density", F.lit(None)), F.lit(-1.0))
    rows = frames.dropDuplicates(["frame_path"]).withColumn("density", density)
    rank = F.row_number().over(Window.partitionBy("video_path").orderBy(F.desc("density"), "timestamp_sec", "frame_path"))
    return rows.withColumn("place", rank).filter(F.col("place") <= most).select("video_path", "frame_path", "place")


def frames_by_unit(frames: DataFrame) -> DataFrame:
    """(unit_id, n, paths): paths of each unit's frames by time (null last), the selected copy before the original, all of them.

    The list of a unit is its value, so its size is that of the unit's frames; rows without a unit are left out.
    """
    path = F.coalesce(F.nullif("selected_frame_path", F.lit("")), F.col("frame_path"))
    rows = frames.filter(F.coalesce("unit_id", F.lit("")) != "").dropDuplicates(["frame_path"])
    listed = F.array_sort(F.collect_list(F.struct(F.col("timestamp_sec").isNull().alias("untimed"), "timestamp_sec", "frame_path", path.alias("path"))))
    return rows.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n"), listed.alias("l")).select("unit_id", "n", F.array_join(F.transform("l", lambda x: x.path), ",").alias("paths"))


def with_unit_ids(frames: DataFrame, units: DataFrame) -> DataFrame:
    """Frames with the id of the first unit (by unit_seq) of their video; a video without units gives an empty id. What the
    frames had as unit_id is replaced."""
    first = units.filter("source_type = 'video'").groupBy(F.col("source_path").alias("video_path")).agg(F.min_by("unit_id", F.struct("unit_seq", "unit_id")).alias("__unit"))
    return frames.drop("unit_id").join(first, "video_path", "left").withColumn("unit_id", F.coalesce("__unit", F.lit(""))).drop("__unit")


def keep_first(vectors: DataFrame, scope: str, seq: str, vector: str, threshold: float) -> DataFrame:
    """(scope, seq, leader): greedy keep-first deduplication by similarity, in the order of seq, within the scope."""
    led = leaders(similar_pairs(vectors, scope, seq, vector, threshold), vectors.select(scope, seq), scope, seq)
    return led.withColumnRenamed("seq", seq)


def keep_first_scenes(frames: DataFrame, histogram: str, threshold: float = 0.98) -> DataFrame:
    """Frames (frame_path, timestamp_sec, histogram: array<double>) less those whose colour histogram correlates with that of a frame
    kept before by at least the threshold; by time, over all videos. A frame without a histogram is kept.

    The correlation of two histograms is the dot product of what is left of them less their mean, at length 1, so this is greedy
    keep-first on vectors; a flat histogram, which has none, is like other flat ones.
    """
    rows = frames.dropDuplicates(["frame_path"]).select("frame_path", "timestamp_sec", F.col(histogram).alias("__h"))
    counted = running_counts(rows.withColumn("__all", F.lit(0)), ["__all"], ["timestamp_sec", "frame_path"], F.floor(F.coalesce("timestamp_sec", F.lit(0.0)) / F.lit(60)))
    saved = Scratch(frames.sparkSession, "scenes").save(counted.select("frame_path", F.col("n").alias("seq"), "__h"), "rows")
    mean = F.aggregate("__h", F.lit(0.0), lambda s, x: s + x) / F.size("__h")
    centred = F.transform("__h", lambda x: x - mean)
    flat = F.concat(F.array(F.lit(1.0)), F.transform("__h", lambda x: F.lit(0.0)))
    vector = F.when(F.exists(centred, lambda x: F.abs(x) > 1e-15), F.concat(F.array(F.lit(0.0)), unit(centred))).otherwise(flat)
    led = keep_first(saved.filter("__h is not null").select(F.lit(0).alias("scope"), "seq", vector.alias("v")), "scope", "seq", "v", threshold)
    return saved.join(led, "seq", "left").filter(F.col("leader").isNull() | (F.col("leader") == F.col("seq"))).select("frame_path", "seq")


def clusters_by_subtype(frames: DataFrame, wanted: dict[str, int], default: int = 120) -> DataFrame:
    """(video_path, k): how many clusters each video gets: what its subtype (of its first frame) wants, at most its frames."""
    n = frames.dropDuplicates(["frame_path"]).groupBy("video_path").agg(F.count(F.lit(1)).alias("n"), F.min_by("subtype", F.struct("timestamp_sec", "frame_path")).alias("subtype"))
    want = F.lit(default)
    for name, k in wanted.items():
        want = F.when(F.col("subtype") == name, k).otherwise(want)
    return n.select("video_path", F.least(want.cast("long"), F.col("n")).alias("k"))


def densest_of_single_clusters(frames: DataFrame, sizes: DataFrame) -> DataFrame:
    """(video_path, frame_path, cluster) of videos that get at most one cluster: their frame of highest text density, the first of equals."""
    one = frames.dropDuplicates(["frame_path"]).join(sizes.filter("k <= 1").select("video_path"), "video_path", "left_semi")
    density = F.coalesce(F.nanvl(F.col("text_density"), F.lit(None)), F.lit(0.0))
    return one.groupBy("video_path").agg(F.min_by("frame_path", F.struct(-density, F.col("timestamp_sec"), F.col("frame_path"))).alias("frame_path")).select("video_path", "frame_path", F.lit(0).alias("cluster"))


def kmeans(points: np.ndarray, k: int, rounds: int = 25, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(labels, centres): Lloyd's rounds from a farthest-first start; empty clusters keep their centre."""
    k = max(1, min(k, len(points)))
    first = int(np.random.default_rng(seed).integers(len(points)))
    picked, gap = [first], ((points - points[first]) ** 2).sum(axis=1)
    while len(picked) < k:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[picked[-1]]) ** 2).sum(axis=1))
    centres, labels = points[picked].astype(float), np.full(len(points), -1)
    for _ in range(rounds):
        d = (centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T
        now = d.argmin(axis=1)
        if (now == labels).all():
            break
        labels = now
        sums, n = np.zeros_like(centres), np.bincount(labels, minlength=k)
        np.add.at(sums, labels, points)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return labels, centres


def _nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T).argmin(axis=1)


def kmeans_centres(vectors: DataFrame, scope: str, item: str, vector: str, k: int, rounds: int = 25, seed: int = 42, part: int = 20_000) -> DataFrame:
    """(scope, cluster, centre): what ``kmeans`` finds on all rows of each scope, in rounds over all tasks.

    Scopes are divided by hash into parts of about ``part`` rows; each part gives its farthest item, or its sums and counts by
    cluster, and these are put together for the scope. A round is written before the next reads it.
    """
    kind = dict(vectors.dtypes)
    scratch = Scratch(vectors.sparkSession, "kmeans")
    n = vectors.groupBy(scope).agg(F.count(F.lit(1)).alias("__n"))
    parts = F.ceil(F.col("__n") / F.lit(part)).cast("long")
    rows = vectors.select(scope, F.col(item).alias("__i"), F.col(vector).cast("array<double>").alias("__v")).join(n, scope)
    rows = scratch.save(rows.withColumns({"__k": parts, "__p": F.pmod(F.xxhash64("__i"), parts)}), "rows")
    sizes = rows.select(scope, "__n", "__k").distinct()

    @F.pandas_udf("long")
    def start(n: pd.Series) -> pd.Series:
        return n.map(lambda x: int(np.random.default_rng(seed).integers(x)))

    def met(step, centres: DataFrame, schema: str) -> DataFrame:
        """What step(rows, centres) gives for each part of each scope."""
        to_all = centres.join(sizes, scope).select(scope, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__k") - 1)).alias("__p"), "cluster", "centre")

        def of(own: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            if not len(own) or not len(c):
                return pd.DataFrame()
            return step(own, np.stack(c.sort_values("cluster")["centre"].to_numpy()))

        return rows.groupBy(scope, "__p").cogroup(to_all.groupBy(scope, "__p")).applyInPandas(of, f"{scope} {kind[scope]}, {schema}")

    def farthest(own: pd.DataFrame, centres: np.ndarray) -> pd.DataFrame:
        own = own.sort_values("__i")
        points = np.stack(own["__v"].to_numpy())
        gap = np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        at = gap.argmax()
        return pd.DataFrame({scope: own[scope].iloc[:1].to_numpy(), "gap": gap[at : at + 1], "__i": own["__i"].iloc[at : at + 1].to_numpy(), "__v": [points[at]]})

    def sums(own: pd.DataFrame, centres: np.ndarray) -> pd.DataFrame:
        points = np.stack(own["__v"].to_numpy())
        labels = _nearest_centre(points, centres)
        found = np.unique(labels)
        return pd.DataFrame({scope: own[scope].iloc[0], "cluster": found, "n": [int((labels == c).sum()) for c in found], "total": [points[labels == c].sum(axis=0) for c in found]})

    place = F.row_number().over(Window.partitionBy(scope).orderBy("__i")) - 1
    first = rows.select(scope, "__i", "__n").withColumn("r", place).filter(F.col("r") == start("__n")).select(scope, "__i")
    centres = scratch.save(rows.join(first, [scope, "__i"]).groupBy(scope).agg(F.first("__v").alias("centre")).select(scope, F.lit(0).alias("cluster"), "centre"), "s0")
    for j in range(1, k):
        got = met(farthest, centres, f"gap double, __i {kind[item]}, __v array<double>").groupBy(scope).agg(F.min_by("__v", F.struct(-F.col("gap"), F.col("__i"))).alias("centre"))
        more = got.join(sizes.filter(F.col("__n") > j), scope, "left_semi").select(scope, F.lit(j).alias("cluster"), "centre")
        centres = scratch.save(centres.unionByName(more), f"s{j}")
        scratch.drop(f"s{j - 1}")
    for r in range(rounds):
        got = met(sums, centres, "cluster int, n long, total array<double>")
        total = got.select(scope, "cluster", "n", F.posexplode("total").alias("at", "x")).groupBy(scope, "cluster", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
        mean = total.groupBy(scope, "cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", (F.col("x") / F.col("n")).alias("m")))), lambda x: x.m).alias("mean"))
        moved = centres.join(mean, [scope, "cluster"], "left").withColumn("moved", F.coalesce(distance("mean", "centre"), F.lit(0.0)))
        following = scratch.save(moved.select(scope, "cluster", F.coalesce("mean", "centre").alias("centre"), "moved"), f"r{r}")
        scratch.drop(f"r{r - 1}" if r else f"s{k - 1}")
        centres = following.drop("moved")
        if not following.filter(F.col("moved") > 1e-12).head(1):
            break
    return centres


def representatives(vectors: DataFrame, scope: str, item: str, vector: str, k: int, text: str | None = None, least_text: float = 60.0) -> DataFrame:
    """(scope, cluster, item, distance, size): the item nearest to each centre of a k-means over all items of each scope.

    With a text density, the densest item of a cluster stands for it instead if its density is above ``least_text`` and the
    nearest one has less than half of it (null and NaN count as 0; of equal ones the first).
    """
    centres = kmeans_centres(vectors, scope, item, vector, k)
    density = F.coalesce(F.nanvl(F.col(text).cast("double"), F.lit(None)), F.lit(0.0)) if text else F.lit(0.0)
    measured = vectors.select(scope, item, vector, density.alias("t")).join(centres, scope).select(scope, item, "cluster", "t", distance(vector, "centre").alias("d"))
    own = measured.groupBy(scope, item).agg(F.min(F.struct("d", "cluster", "t")).alias("m"))
    best = own.groupBy(scope, "m.cluster").agg(F.min(F.struct("m.d", item, "m.t")).alias("b"), F.min(F.struct((-F.col("m.t")).alias("t"), F.col(item), F.col("m.d").alias("d"))).alias("x"), F.count(F.lit(1)).alias("size"))
    over = (-F.col("x.t") > least_text) & (F.col("b.t") < -F.col("x.t") * 0.5)
    pick = lambda c: F.when(over, F.col(f"x.{c}")).otherwise(F.col(f"b.{c}"))
    return best.select(scope, "cluster", pick(item).alias(item), pick("d").alias("distance"), "size")
