"""The best representative of each group of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptloom.functions.text import id_form, name_form, strip_blanks

#: Parts into which each group is cut for the first ranking at least, so that no group is ordered in one task; with more shuffle
#: partitions there are as many parts as partitions.
SALTS = 32


def best_rows(rows: DataFrame, group: str, item: str, orders: dict[str, list[Column]], salts: int | None = None) -> DataFrame:
    """For each group with two different items or more, the top item by each order: (group, *orders).

    Window ranking in two steps: first within (group, salt), where all but the leaders drop out, then among the
    leaders. Orders must be total on items; repeat rows of an item change nothing.
    """
    salts = salts or max(SALTS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(item), F.lit(salts)))
    for keys in ([group, "__salt"], [group]):
        over = Window.partitionBy(*keys)
        low, high = ("__low", "__high") if "__low" in salted.columns else (item, item)
        salted = salted.withColumns(
            {f"__r_{k}": F.row_number().over(over.orderBy(*o)) for k, o in orders.items()} | {"__low": F.min(low).over(over), "__high": F.max(high).over(over)}
        ).filter(" or ".join(f"__r_{k} = 1" for k in orders))
    top = [F.max(F.when(F.col(f"__r_{k}") == 1, F.col(item))).alias(k) for k in orders]
    return salted.filter("__low < __high").groupBy(group).agg(*top)


def trusted(confidence: str = "confidence") -> Column:
    """A confidence outside 0..1 (NaN as well) counts as missing."""
    return F.when(F.col(confidence).between(0.0, 1.0), F.col(confidence))


def choose_survivors(concepts: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_id, survivor_id, definition_id) of each group with at least two concepts in ``concepts``.

    The survivor ranks by trust, frequency, recency and the smaller id, nulls last; the definition by its length without
    surrounding blanks, then the smaller id. Groups known only elsewhere, and groups of one, give no row.
    """
    rows = concepts.select(
        id_form("concept_id").alias("concept_id"),
        trusted().alias("trust"),
        "frequency",
        "extracted_at",
        F.coalesce(F.char_length(strip_blanks("definition")), F.lit(0)).alias("size"),
    ).join(groups, "concept_id")
    orders = {
        "survivor_id": [F.desc_nulls_last("trust"), F.desc_nulls_last("frequency"), F.desc_nulls_last("extracted_at"), F.asc("concept_id")],
        "definition_id": [F.desc("size"), F.asc("concept_id")],
    }
    return best_rows(rows, "group_id", "concept_id", orders)


def merged_concepts(concepts: DataFrame, groups: DataFrame) -> DataFrame:
    """One concept per group of two or more: the survivor's fields, the fullest definition, the sum of known
    frequencies over distinct members, the span of extraction times and the number of members."""
    chosen = choose_survivors(concepts, groups)
    fields = ("name", "type", "domain", "chapter_id", "source_type", "confidence", "definition", "frequency", "extracted_at")
    # Of repeat rows that differ the one that ranks first stands for its concept, as in the choice of survivors.
    own = F.struct(F.coalesce(-trusted(), F.lit(1.0)).alias("t"), F.coalesce(-F.col("frequency").cast("double"), F.lit(float("inf"))).alias("f"), F.coalesce(-F.unix_micros("extracted_at"), F.lit((1 << 63) - 1)).alias("x"), F.struct(*[F.col(c) for c in fields if c not in ("confidence", "frequency", "extracted_at")]).alias("rest"))
    row = F.struct(*fields)
    rows = concepts.select(id_form("concept_id").alias("concept_id"), own.alias("o"), row.alias("r")).groupBy("concept_id").agg(F.min_by("r", "o").alias("r")).select("concept_id", "r.*")
    base = rows.select(F.col("concept_id").alias("survivor_id"), "name", "type", "domain", "chapter_id", "source_type", trusted().alias("confidence"))
    said = strip_blanks("definition")
    text = concepts.select(id_form("concept_id").alias("definition_id"), said.alias("d")).groupBy("definition_id").agg(F.max_by("d", F.struct(F.coalesce(F.char_length("d"), F.lit(0)), "d")).alias("definition"))
    total = rows.join(groups, "concept_id").groupBy("group_id").agg(
        F.count(F.lit(1)).alias("n_members"), F.coalesce(F.sum(F.col("frequency").cast("long")), F.lit(0)).alias("frequency"), F.min("extracted_at").alias("first_at"), F.max("extracted_at").alias("last_at")
    )
    return chosen.join(total, "group_id").join(base, "survivor_id").join(text, "definition_id").select(
        "group_id", "survivor_id", "definition_id", "name", "type", "domain", "chapter_id", "source_type", "confidence", "definition", "n_members", "frequency", "first_at", "last_at"
    )


def merged_aliases(concepts: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_id, alias): the names of the group's other members that do not compare equal to the survivor's name.

    One row per alias, in its smallest spelling, so that a giant group needs no array. Blank and null names are none.
    """
    rows = concepts.select(id_form("concept_id").alias("concept_id"), strip_blanks("name").alias("name"), name_form("name").alias("form"))
    chosen = choose_survivors(concepts, groups).select("group_id", "survivor_id")
    own = chosen.join(rows, F.col("survivor_id") == F.col("concept_id")).groupBy("group_id").agg(F.min("form").alias("own"))
    names = rows.filter(F.col("form") != "").join(groups, "concept_id").groupBy("group_id", "form").agg(F.min("name").alias("alias"))
    return names.join(own, "group_id").filter(~F.col("form").eqNullSafe(F.col("own"))).select("group_id", "alias")
