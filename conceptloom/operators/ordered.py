"""Row numbers, running counts and predecessors along an order, without one task for each key.

Keys are cut into chunks of the order; windows run inside a chunk, and what a chunk needs to know of those before it comes
from a window over one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_counts(df: DataFrame, keys: list[str], order: list[str], chunk: Column, flag: Column | None = None) -> DataFrame:
    """Add n (number of the row in its key, from 0), flags (flagged rows up to and with this one) and since (rows since the
    last flagged row, which has 0; without any before, since the first row). The order must be total; chunk must not
    decrease along it. A null flag counts as false."""
    flag = F.coalesce(flag, F.lit(False)) if flag is not None else F.lit(False)
    rows = df.withColumns({"__chunk": chunk, "__flag": flag.cast("long")})
    inside = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"__n": F.row_number().over(inside).cast("long") - 1, "__sum": F.sum("__flag").over(upto)})
    rows = rows.withColumn("__last", F.max(F.when(F.col("__flag") == 1, F.col("__n"))).over(upto))
    carry = rows.groupBy(*keys, "__chunk").agg(F.count(F.lit(1)).alias("__rows"), F.sum("__flag").alias("__flags"), F.max("__last").alias("__at"))
    over = Window.partitionBy(*keys).orderBy("__chunk")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.withColumn("__rows0", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    carry = carry.select(
        *keys, "__chunk", "__rows0", F.coalesce(F.sum("__flags").over(before), F.lit(0)).alias("__flags0"), F.max(F.col("__rows0") + F.col("__at")).over(before).alias("__at0")
    )
    n = F.col("__rows0") + F.col("__n")
    return (
        rows.join(carry, [*keys, "__chunk"])
        .withColumns({"n": n, "flags": F.col("__flags0") + F.col("__sum"), "since": n - F.coalesce(F.col("__rows0") + F.col("__last"), F.col("__at0"), F.lit(0))})
        .drop("__chunk", "__flag", "__n", "__sum", "__last", "__rows0", "__flags0", "__at0")
    )


def with_previous(df: DataFrame, keys: list[str], order: list[str], chunk: Column, columns: dict[str, str]) -> DataFrame:
    """Add, under new names, columns of the row before in the key (null at the first)."""
    rows = df.withColumn("__chunk", chunk)
    inside = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    value = F.struct(*[F.col(c).alias(name) for name, c in columns.items()])
    rows = rows.withColumns({"__lag": F.lag(value).over(inside)})
    last = rows.groupBy(*keys, "__chunk").agg(F.max_by(value, F.struct(*order)).alias("__end"))
    last = last.select(*keys, "__chunk", F.lag("__end").over(Window.partitionBy(*keys).orderBy("__chunk")).alias("__carried"))
    rows = rows.join(last, [*keys, "__chunk"]).withColumn("__lag", F.coalesce("__lag", "__carried"))
    return rows.withColumns({name: F.col(f"__lag.{name}") for name in columns}).drop("__lag", "__carried", "__chunk")
