"""References to records that do not exist, by as-of matching on runs of existence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptloom.functions.text import name_form, present
from conceptloom.operators.scans import running_extremes
from conceptloom.runtime import Scratch

#: Before and after any time, as microseconds.
BEGINNING, END = -(1 << 60), 1 << 60
DAY = 86_400_000_000
#: Runs of a key up to which its references are compared with all of them.
FEW_RUNS = 8


def existence_runs(parents: DataFrame, keys: list[str], created: str, deleted: str) -> DataFrame:
    """Lives of the records of each key, compressed into runs.

    ``created`` and ``deleted`` are longs (microseconds; null: never). The times at which a key exists are sorted
    integers; contiguous ones become one run [run_start, run_end), however many lives overlap in it. Each run is valid
    for as-of matches from its start to run_next, the start of the next. A run at BEGINNING without length stands
    before the first, so that every time matches exactly one run of a key that was ever there. last_created is the
    latest creation of the key.
    """
    scratch = Scratch(parents.sparkSession, "runs")
    lives = (
        parents.select(*keys, F.col(created).alias("created"), F.coalesce(F.col(deleted), F.lit(END)).alias("deleted"))
        .groupBy(*keys, "created")
        .agg(F.max("deleted").alias("deleted"))
    )
    lives = scratch.save(lives, "lives")  # read several times below
    born = lives.filter(F.col("created").isNotNull() & (F.col("deleted") > F.col("created")))
    chunk = F.floor(F.col("created") / F.lit(30 * DAY))
    seen = running_extremes(born, keys, "created", chunk, max_before={"reached": "deleted"})
    starts = seen.filter(F.col("reached").isNull() | (F.col("reached") < F.col("created"))).select(*keys, F.col("created").alias("run_start"), F.col("reached").alias("ended"))
    # The end of a run is what was reached before the next run starts; the last run ends at the latest end of all.
    whole = lives.groupBy(*keys).agg(F.max("created").alias("last_created"), F.max(F.when(F.col("deleted") > F.col("created"), F.col("deleted"))).alias("latest_end"))
    first = whole.select(*keys, F.lit(BEGINNING).alias("run_start"), F.lit(None).cast("long").alias("ended"))
    after = running_extremes(
        starts.unionByName(first), keys, "run_start", F.floor(F.col("run_start") / F.lit(30 * DAY)), min_after={"run_next": "run_start", "next_ended": "ended"}
    )
    return after.join(whole, keys).select(
        *keys,
        "run_start",
        F.when(F.col("run_start") == BEGINNING, F.lit(BEGINNING)).otherwise(F.coalesce("next_ended", "latest_end")).alias("run_end"),
        F.coalesce("run_next", F.lit(END)).alias("run_next"),
        "last_created",
    )


def run_before(refs: DataFrame, runs: DataFrame, keys: list[str], few: int = FEW_RUNS) -> DataFrame:
    """References (keys, __at, ...) with the run of their key that holds as of __at: __run_end and __last_created, null without any.

    The runs of a key don't overlap, so one with at most ``few`` of them is met in an equi-join that compares each reference
    with all, and that adaptive execution splits at a hot key. References of keys with more runs are laid among the run starts
    and take the last one before them, carried along in chunks of a day: no comparison of all with all.
    """
    scratch = Scratch(refs.sparkSession, "runs-before")
    runs = scratch.save(runs, "runs")
    many = scratch.save(runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > few).select(*keys), "many")
    crowded = bool(many.head(1))
    plain = refs.join(many, keys, "left_anti") if crowded else refs
    some = runs.join(many, keys, "left_anti") if crowded else runs
    some = some.select(*[F.col(k).alias(f"__p_{k}") for k in keys], *[F.col(c).alias(f"__{c}") for c in ("run_start", "run_end", "run_next", "last_created")])
    on = (F.col("__at") >= F.col("__run_start")) & (F.col("__at") < F.col("__run_next"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__p_{k}"))
    met = plain.join(some, on, "left").select(*refs.columns, "__run_end", "__last_created")
    if not crowded:
        return met
    # Twice the time, and one more for references: a run that starts at that very time lies before them.
    starts = runs.join(many, keys, "left_semi").select(*keys, (2 * F.col("run_start")).alias("__order"), F.struct("run_start", "run_end", "last_created").alias("__run"), F.lit(None).cast(refs.select(F.struct(*refs.columns)).schema[0].dataType).alias("__ref"))
    laid = refs.join(many, keys, "left_semi").select(*keys, (2 * F.col("__at") + 1).alias("__order"), F.lit(None).cast(starts.schema["__run"].dataType).alias("__run"), F.struct(*refs.columns).alias("__ref"))
    carried = running_extremes(starts.unionByName(laid), keys, "__order", F.floor(F.col("__order") / F.lit(2 * DAY)), max_before={"__last": "__run"}).filter(F.col("__ref").isNotNull())
    return met.unionByName(carried.select("__ref.*", F.col("__last.run_end").alias("__run_end"), F.col("__last.last_created").alias("__last_created")))


def orphan_references(references: DataFrame, parents: DataFrame, keys: list[str], at: str, created: str, deleted: str) -> DataFrame:
    """The references whose key had no living record at their time, with kind 'missing', 'late' or 'deleted'.

    Each reference matches, as of its time, the run before it; it is an orphan if its time lies beyond that run's end.
    missing: no record of the key at all; late: a record is created after the reference; deleted: all that was there
    had ended. A reference without time is an orphan; a record without creation time never lives, one that ends no
    later than it begins neither. Null keys are no references. Columns of ``references`` stay as they are, but for one that is itself named kind.
    """
    runs = existence_runs(parents.dropna(subset=keys), keys, created, deleted)
    met = run_before(references.dropna(subset=keys).withColumn("__at", F.coalesce(F.col(at), F.lit(BEGINNING))), runs, keys)
    kind = (
        F.when(F.col("__run_end").isNull(), "missing")
        .when(F.col("__at") < F.col("__run_end"), None)
        .when(F.col("__last_created") > F.col(at), "late")
        .otherwise("deleted")
    )
    return met.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select(*[c for c in references.columns if c != "kind"], "kind")


def relation_references(relations: DataFrame) -> DataFrame:
    """Both endpoints of each raw relation as references: relation_id, side, chapter_id, key, at, month."""
    ends = F.array(*[F.struct(F.lit(side).alias("side"), name_form(f"{side}_name").alias("key")) for side in ("source", "target")])
    return (
        relations.select("relation_id", "chapter_id", "extracted_at", F.explode(ends).alias("e"))
        .select("relation_id", "e.side", "chapter_id", "e.key", F.unix_micros("extracted_at").alias("at"))
        .filter(present(F.col("key")))
    )


def concept_names(canonical: DataFrame) -> DataFrame:
    """Each name and alias of each canonical concept as a parent record: chapter_id, key, created, deleted."""
    names = F.concat(F.array("name"), F.coalesce(F.col("aliases"), F.array().cast("array<string>")))
    return (
        canonical.select("chapter_id", F.unix_micros("created_at").alias("created"), F.unix_micros("deleted_at").alias("deleted"), F.explode(names).alias("name"))
        .select("chapter_id", name_form("name").alias("key"), "created", "deleted")
        .filter(present(F.col("key")))
    )


def orphan_relations(relations: DataFrame, canonical: DataFrame) -> DataFrame:
    """Endpoints of raw relations that named no living concept of their chapter: relation_id, side, kind, month.

    Repeat rows give one case. A relation without chapter matches nothing, so its endpoints are missing.
    """
    refs = relation_references(relations).withColumn("chapter_id", F.coalesce("chapter_id", F.lit("")))
    cases = orphan_references(refs, concept_names(canonical), ["chapter_id", "key"], "at", "created", "deleted")
    return cases.select("relation_id", "side", "kind", F.date_format(F.timestamp_micros("at"), "yyyy-MM").alias("month")).distinct()


def orphan_counts(relations: DataFrame, canonical: DataFrame) -> DataFrame:
    """Orphans per endpoint, month of extraction and kind."""
    return orphan_relations(relations, canonical).groupBy("side", "month", "kind").agg(F.count(F.lit(1)).alias("n_orphans"))
