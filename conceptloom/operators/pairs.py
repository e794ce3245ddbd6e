"""Similar pairs of unit vectors, block against block, without emitting the pairs that are not."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptloom.functions.vectors import norm

#: Rows of a block at least, and blocks into which a cell is divided at most: a row is copied once for each block that it
#: meets, so copies are bounded by PARTS for each near cell however many rows there are, and a task works tile by tile.
BLOCK, PARTS = 2_000, 64


def blocked(rows: DataFrame, scope: str, item: str, near: tuple[int, ...], block: int = BLOCK) -> DataFrame:
    """Rows (scope, item, cell, ...) once for every pair of blocks that they are in: __x <= __y are the blocks, __b is their own.

    Cells of one scope meet themselves and those ``near`` them; a cell of more than ``block`` rows is divided by hash.
    """
    cells = rows.groupBy(scope, "cell").agg(F.least(F.lit(PARTS), F.ceil(F.count(F.lit(1)) / F.lit(block))).cast("long").alias("subs"))
    own = rows.join(cells, [scope, "cell"]).withColumn("sub", F.pmod(F.xxhash64(item), F.col("subs"))).drop("subs")
    met = cells.select(scope, F.explode(F.array(*[F.col("cell") + k for k in near])).alias("cell"), F.col("cell").alias("other"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)).alias("other_sub"))
    name = lambda c, s: F.concat(F.lpad(c.cast("string"), 8, "0"), F.lit("/"), F.lpad(s.cast("string"), 9, "0"))
    both = own.join(met, [scope, "cell"]).withColumns({"__b": name(F.col("cell"), F.col("sub")), "__o": name(F.col("other"), F.col("other_sub"))})
    return both.withColumns({"__x": F.least("__b", "__o"), "__y": F.greatest("__b", "__o")}).drop("__o", "cell", "sub", "other", "other_sub")


def two_blocks(rows: pd.DataFrame, item: str) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """The rows of both blocks of a task, in order, and whether they are one block."""
    rows = rows.drop_duplicates([item, "__b"]).sort_values(item)
    x, y = rows["__x"].iloc[0], rows["__y"].iloc[0]
    return rows[rows["__b"] == x], rows[rows["__b"] == y], x == y


def tiles(n: int, m: int, same: bool, side: int = BLOCK):
    """Slices that cover the pairs of two blocks, those of one block with itself once."""
    for i in range(0, n, side):
        for j in range(i if same else 0, m, side):
            yield slice(i, i + side), slice(j, j + side)


def _blocks(vectors: DataFrame, scope: str, item: str, vector: str, reach: float | None, block: int) -> DataFrame:
    """Vectors in blocks. With a reach (an angle), cells are by the angle to one fixed direction: vectors whose angles to it
    differ by more than the reach are farther apart than that, so only neighbouring cells meet."""
    rows = vectors.select(scope, item, F.col(vector).cast("array<double>").alias("v")).filter(norm("v") > 0)
    if reach is None or reach >= math.pi / 2:
        return blocked(rows.withColumn("cell", F.lit(0).cast("long")), scope, item, (0,), block)
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x) / (norm("v") * F.sqrt(F.size("v")))
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), total)))
    return blocked(rows.withColumn("cell", F.floor(angle / F.lit(reach + 1e-9))), scope, item, (-1, 0, 1), block)


def _products(rows: pd.DataFrame, item: str):
    """(dot products, items, items, whether these are one tile) of two blocks, tile by tile."""
    a, b, same = two_blocks(rows, item)
    if not len(a) or not len(b):
        return
    x, y = np.stack(a["v"].to_numpy()), np.stack(b["v"].to_numpy())
    p, q = a[item].to_numpy(), b[item].to_numpy()
    for i, j in tiles(len(x), len(y), same):
        yield x[i] @ y[j].T, p[i], q[j], same and i == j


def _apply(rows: DataFrame, scope: str, of: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    return rows.groupBy(scope, "__x", "__y").applyInPandas(of, schema)


def similar_pairs(vectors: DataFrame, scope: str, item: str, vector: str, threshold: float, block: int = BLOCK) -> DataFrame:
    """(scope, seq_a, seq_b, similarity) of unit vectors in one scope with a dot product of at least the threshold, seq_a < seq_b.

    Exact: each two vectors that can reach the threshold meet in one pair of blocks, multiplied as matrices.
    """
    kind = dict(vectors.dtypes)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dots, a, b, same in _products(rows, item):
            i, j = np.nonzero(dots >= threshold)
            if same:
                i, j = i[i < j], j[i < j]
            first = a[i] < b[j]
            out.append(pd.DataFrame({scope: rows[scope].iloc[0], "seq_a": np.where(first, a[i], b[j]), "seq_b": np.where(first, b[j], a[i]), "similarity": dots[i, j]}))
        return pd.concat(out) if out else pd.DataFrame()

    reach = math.acos(max(-1.0, min(1.0, threshold - 1e-6)))
    return _apply(_blocks(vectors, scope, item, vector, reach, block), scope, of, f"{scope} {kind[scope]}, seq_a {kind[item]}, seq_b {kind[item]}, similarity double")


def least_similarity(vectors: DataFrame, scope: str, item: str, vector: str, block: int = BLOCK) -> DataFrame:
    """(scope, n, least): the smallest dot product of two members of each scope; 1 for a single one."""
    kind = dict(vectors.dtypes)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        low = []
        for dots, _, _, same in _products(rows, item):
            dots = dots[np.triu_indices(len(dots), 1)] if same else dots
            low += [float(dots.min())] if dots.size else []
        return pd.DataFrame({scope: rows[scope].iloc[0], "m": [min(low)] if low else []})

    low = _apply(_blocks(vectors, scope, item, vector, None, block), scope, of, f"{scope} {kind[scope]}, m double").groupBy(scope).agg(F.min("m").alias("m"))
    return vectors.groupBy(scope).agg(F.count(F.lit(1)).alias("n")).join(low, scope, "left").select(scope, "n", F.coalesce("m", F.lit(1.0)).alias("least"))
