"""Matching records by nearest time through nearest-neighbour intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptloom.operators.scans import running_extremes
from conceptloom.runtime import Scratch

#: Length of the shortest interval class of the index, and of the chunks in which spans are ordered.
BASE, CHUNK = 8.0, 600.0


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def _distinct_spans(spans: DataFrame, scratch: Scratch) -> DataFrame:
    rows = spans.filter(_finite(F.col("a")) & _finite(F.col("b"))).groupBy("entity", "a", "b").agg(F.min("item").alias("item"))
    return scratch.save(rows.withColumns({"lo": F.least("a", "b"), "hi": F.greatest("a", "b")}), "spans")


def neighbour_intervals(rows: DataFrame, tolerance: float, scratch: Scratch) -> DataFrame:
    """For spans (entity, a, b, item, lo, hi), intervals (entity, since, until, item, lo, hi, a) that hold every time outside all
    whole cells of a span at which it can be the nearest.

    Runs of overlapping spans leave gaps; a gap is halved at its midpoint, each half no wider than the tolerance, and given
    to the best span that ends or starts there. Within a span its distance is 0; of it these intervals are the two ends that
    don't fill a cell of the shortest width. They are slightly widened: they may overlap where distances tie, and the final
    choice among matches is exact.
    """
    chunk = F.floor(F.col("lo") / F.lit(CHUNK))
    starts = rows.groupBy("entity", "lo").agg(F.max("hi").alias("hi"), F.min(F.struct(F.col("a").alias("a"), F.col("item").alias("item"), F.col("b").alias("b"))).alias("first"))
    starts = scratch.save(running_extremes(starts, ["entity"], "lo", chunk, max_before={"reached": "hi"}).select("entity", "lo", "first", "reached"), "starts")
    first, last = F.ceil(F.col("lo") / F.lit(BASE)) * F.lit(BASE), F.floor(F.col("hi") / F.lit(BASE)) * F.lit(BASE)
    end = lambda x, y: F.struct(x.cast("double").alias("since"), y.cast("double").alias("until"))
    ends = F.when(first < last, F.array(end(F.col("lo"), first), end(last, F.col("hi")))).otherwise(F.array(end(F.col("lo"), F.col("hi"))))
    inside = rows.withColumn("e", F.explode(ends)).select("entity", "e.since", "e.until", "item", "lo", "hi", "a")
    runs = starts.filter(F.col("reached").isNull() | (F.col("reached") < F.col("lo")))
    gap = F.coalesce((F.col("lo") + F.col("reached")) / 2, F.lit(float("-inf")))
    before = runs.select(
        "entity", F.greatest(F.col("lo") - F.lit(tolerance), gap).alias("since"), F.col("lo").alias("until"),
        F.col("first.item").alias("item"), "lo", F.greatest("first.a", "first.b").alias("hi"), F.col("first.a").alias("a"),
    )
    # A run ends where the one after it says what was reached; the last run ends at the latest end.
    latest = rows.groupBy("entity").agg(F.max("hi").alias("hi")).select("entity", "hi", F.lit(float("inf")).alias("then"))
    stops = runs.filter(F.col("reached").isNotNull()).select("entity", F.col("reached").alias("hi"), F.col("lo").alias("then")).unionByName(latest)
    best = rows.groupBy("entity", "hi").agg(F.min(F.struct((-F.col("a")).alias("minus_a"), F.col("item").alias("item"), F.col("lo").alias("lo"))).alias("last"))
    after = stops.join(best, ["entity", "hi"]).select(
        "entity", F.col("hi").alias("since"), F.least(F.col("hi") + F.lit(tolerance), (F.col("hi") + F.col("then")) / 2).alias("until"),
        F.col("last.item").alias("item"), F.col("last.lo").alias("lo"), "hi", (-F.col("last.minus_a")).alias("a"),
    )
    slack = lambda c: F.lit(1e-9) * (F.lit(1.0) + F.abs(c))
    return inside.unionByName(before).unionByName(after).withColumns({"since": F.col("since") - slack(F.col("since")), "until": F.col("until") + slack(F.col("until"))})


def whole_cells(rows: DataFrame) -> DataFrame:
    """(entity, class, cell, item, lo, hi, a): for cells of width BASE * 2^class that spans fill, the span that begins nearest of
    those that begin before, and of those that begin (reversed) after every time in it.

    A span fills at most two cells of each width that no larger one of its cells holds, and of all spans that fill a cell only
    these two can be the nearest at a time inside: spans nested in one another, however deep, leave two candidates.
    """
    least, beyond = F.ceil(F.col("lo") / F.lit(BASE)), F.floor(F.col("hi") / F.lit(BASE))
    filled = rows.withColumns({"__l": least, "__r": beyond}).filter("__l < __r")
    widest = filled.agg(F.max(F.col("__r") - F.col("__l"))).first()[0] or 0

    def of_class(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        low, high = F.ceil(F.col("__l") / size).cast("long"), F.floor(F.col("__r") / size).cast("long")
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        one = F.when((low < high) & odd(low), low)
        two = F.when((low < high) & odd(high), high - 1)
        return F.transform(F.filter(F.array(one, two), lambda c: c.isNotNull()), lambda c: F.struct(k.alias("class"), c.alias("cell")))

    classes = F.sequence(F.lit(0), F.lit(int(widest).bit_length()))
    cells = filled.withColumn("c", F.explode(F.flatten(F.transform(classes, of_class)))).select("entity", "c.class", "c.cell", "item", "lo", "hi", "a", (F.col("a") > F.col("lo")).alias("__back"))
    near = F.when(F.col("__back"), F.col("a")).otherwise(-F.col("a"))
    best = cells.groupBy("entity", "class", "cell", "__back").agg(F.min(F.struct(near.alias("n"), "item", "lo", "hi", "a")).alias("m"))
    return best.select("entity", "class", "cell", "m.item", "m.lo", "m.hi", "m.a")


def nearest_match(left: DataFrame, spans: DataFrame, tolerance: float) -> DataFrame:
    """The nearest span of the same entity for each left row (key, entity, at): (key, item, distance).

    Range join through interval indexes: an interval of class k is no longer than BASE * 2^k and lies in at most two cells of
    that width, and cells that a span fills hold at most two candidates; a time looks into one cell of each class in use.
    Cells split a hot entity. Distance is 0 from the smaller to the larger end and otherwise the gap to the nearer one; among
    equal distances the smallest |at - a| wins, then the smaller item. Rows without a span within the tolerance, or without
    time, do not come out. A key whose rows differ gets the best match of any of them.
    """
    scratch = Scratch(left.sparkSession, "nearest")
    rows = _distinct_spans(spans, scratch)
    length = F.greatest(F.col("until") - F.col("since"), F.lit(BASE))
    class_ = F.ceil(F.log2(length / F.lit(BASE))).cast("int")
    intervals = neighbour_intervals(rows, tolerance, scratch).withColumn("class", class_).withColumn("width", F.lit(BASE) * F.pow(F.lit(2.0), F.col("class")))
    cells = intervals.withColumn("cell", F.explode(F.sequence(F.floor(F.col("since") / F.col("width")), F.floor(F.col("until") / F.col("width"))))).drop("width")
    whole = whole_cells(rows).withColumns({"since": F.lit(float("-inf")), "until": F.lit(float("inf"))})
    cells = scratch.save(cells.select("entity", "class", "cell", "since", "until", "item", "lo", "hi", "a").unionByName(whole), "cells")
    classes = [r[0] for r in cells.select("class").distinct().collect()]  # at most one for each power of two
    looks = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.floor(F.col("at") / F.lit(BASE * 2.0**c)).alias("cell")) for c in classes])) if classes else None
    times = left.filter(_finite(F.col("at"))).select("key", "entity", "at").distinct()
    if looks is None:
        return times.filter("false").select("key", F.lit("").alias("item"), F.lit(0.0).alias("distance"))
    times = times.withColumn("look", looks).select("key", F.col("entity").alias("__e"), "at", F.col("look.class").alias("__k"), F.col("look.cell").alias("__c"))
    on = (F.col("__e") == F.col("entity")) & (F.col("__k") == F.col("class")) & (F.col("__c") == F.col("cell")) & F.col("at").between(F.col("since"), F.col("until"))
    gap = F.greatest(F.lit(0.0), F.col("lo") - F.col("at"), F.col("at") - F.col("hi"))
    met = times.join(cells, on).withColumn("distance", gap).filter(F.col("distance") <= F.lit(tolerance))
    best = met.groupBy("key").agg(F.min(F.struct("distance", F.abs(F.col("at") - F.col("a")).alias("off"), "item")).alias("m"))
    return best.select("key", "m.item", "m.distance")


def frame_units(frames: DataFrame, units: DataFrame, tolerance: float = 2.5) -> DataFrame:
    """(frame_path, unit_id, distance): the nearest unit of each frame's video within the tolerance.

    Candidates are units of source type video whose span ends are both present and not both 0. Frames without time or
    match do not come out; repeat rows count once.
    """
    spans = units.filter((F.col("source_type") == "video") & ~((F.col("span_start") == 0) & (F.col("span_end") == 0))).select(
        F.col("source_path").alias("entity"), F.col("span_start").alias("a"), F.col("span_end").alias("b"), F.col("unit_id").alias("item")
    )
    left = frames.select(F.col("frame_path").alias("key"), F.col("video_path").alias("entity"), F.col("timestamp_sec").alias("at"))
    return nearest_match(left.dropna(), spans.dropna(), tolerance).select(F.col("key").alias("frame_path"), F.col("item").alias("unit_id"), "distance")


def all_frames(frames: DataFrame, units: DataFrame, tolerance: float = 2.5) -> DataFrame:
    """Every frame once, with its nearest unit and distance, or with nulls."""
    keys = frames.select("frame_path").distinct()
    return keys.join(frame_units(frames, units, tolerance), "frame_path", "left")
