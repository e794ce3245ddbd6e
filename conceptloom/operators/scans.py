"""Running extremes over ordered keys without one task for each key.

A window over a whole key gives a hot key to one task. Here keys are cut into chunks of the ordering column; extremes
of the chunks are carried over by a window on the few chunk rows, and rows are ordered only within their chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_extremes(df: DataFrame, keys: list[str], order: str, chunk: Column, *, max_before: dict[str, str] | None = None, min_after: dict[str, str] | None = None) -> DataFrame:
    """Add, for each row, extremes over the rows of its key with strictly smaller or larger ``order``.

    max_before and min_after map new column names to the columns whose maximum over smaller, or minimum over larger
    order values is wanted. ``chunk`` must not decrease with ``order``. Rows of equal order see the same rows.
    """
    max_before, min_after = max_before or {}, min_after or {}
    rows = df.withColumn("__chunk", chunk)
    carry = rows.groupBy(*keys, "__chunk").agg(
        *[F.max(v).alias(f"__c_{k}") for k, v in max_before.items()], *[F.min(v).alias(f"__c_{k}") for k, v in min_after.items()]
    )
    over = Window.partitionBy(*keys).orderBy("__chunk")
    before, after = over.rowsBetween(Window.unboundedPreceding, -1), over.rowsBetween(1, Window.unboundedFollowing)
    carry = carry.select(*keys, "__chunk", *[F.max(f"__c_{k}").over(before).alias(f"__c_{k}") for k in max_before], *[F.min(f"__c_{k}").over(after).alias(f"__c_{k}") for k in min_after])
    rows = rows.join(carry, [*keys, "__chunk"])
    # Equal order values are one peer group: the extremes of a peer group come from the groups beside it.
    peers = Window.partitionBy(*keys, "__chunk").orderBy(order)
    rows = rows.withColumn("__rank", F.dense_rank().over(peers))
    by_rank = Window.partitionBy(*keys, "__chunk").orderBy("__rank")
    for k, v in max_before.items():
        rows = rows.withColumn(k, F.greatest(F.col(f"__c_{k}"), F.max(v).over(by_rank.rangeBetween(Window.unboundedPreceding, -1))))
    for k, v in min_after.items():
        rows = rows.withColumn(k, F.least(F.col(f"__c_{k}"), F.min(v).over(by_rank.rangeBetween(1, Window.unboundedFollowing))))
    return rows.drop("__chunk", "__rank", *[f"__c_{k}" for k in [*max_before, *min_after]])
