"""Vector operators: nearest seeds, triage, density clusters and change points."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nearest_seed(vectors: DataFrame, key: str, vector: str, seeds: DataFrame) -> DataFrame:
    """(key, seed, similarity): the seed (seed, place, seed_vector) most similar to each vector, the first on ties; without any
    positive similarity 'general' and 0. Seeds are a short fixed list, one for each domain, and are checked to be that; rows
    without a vector are left out."""
    listed = seeds.orderBy("place").limit(1001).collect()
    if len(listed) > 1000:
        raise ValueError("more than 1,000 seeds")
    names, table = [r["seed"] for r in listed], np.array([r["seed_vector"] for r in listed], dtype=float)

    @F.pandas_udf("seed string, similarity double")
    def nearest(batch: pd.Series) -> pd.DataFrame:
        if not names or not len(batch):
            return pd.DataFrame({"seed": ["general"] * len(batch), "similarity": 0.0})
        near = np.stack(batch.to_numpy()).astype(float) @ table.T
        at, top = near.argmax(axis=1), near.max(axis=1)  # the first of equal ones
        return pd.DataFrame({"seed": [names[i] if t > 0 else "general" for i, t in zip(at, top)], "similarity": np.maximum(top, 0.0)})

    return vectors.filter(F.col(vector).isNotNull()).withColumn("__m", nearest(vector)).select(key, "__m.seed", "__m.similarity")


def triage(similarity, merge: float, check: float):
    """What becomes of a cluster: merged, checked by a decider, or split back."""
    return F.when(similarity >= merge, "merge").when(similarity >= check, "check").otherwise("split")


def density_tree(points: np.ndarray, least: int, room: int = 1_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance, near, far) of the edges of the points' mutual-reachability tree, shortest first, on ties the smallest ends first.

    Equal points are one kind, whose distances are computed once: the points of a kind that aren't in the tree yet have the same
    nearest one in it, and the first of them comes next. So the tree is the one that all points give one by one, in time
    quadratic in the kinds. Distances are computed as they are needed, ``room`` at a time, never held as a matrix.
    """
    n = len(points)
    rows = points + 0  # a zero has one sign
    kind = pd.factorize(np.array([x.tobytes() for x in rows], dtype=object))[0]  # in the order of their first points
    _, first, count = np.unique(kind, return_index=True, return_counts=True)
    points, m = rows[first].astype(float), len(first)
    members = np.append(kind.argsort(kind="stable"), n)  # by kind, each kind's in order
    ends = count.cumsum()
    following = ends - count
    sq = (points**2).sum(axis=1)

    def apart(at: slice | int) -> np.ndarray:
        return np.sqrt(np.maximum(sq[at][..., None] + sq - 2 * points[at] @ points.T, 0))

    core = np.empty(m)
    for i in range(0, m, step := max(1, room // m)):
        far = apart(at := slice(i, i + step))
        far[np.arange(len(far)), np.arange(i, i + len(far))] = 0
        nearest = np.argpartition(far, min(least, m - 1), axis=1)[:, : least + 1]
        near = np.take_along_axis(far, nearest, axis=1)
        order = near.argsort(axis=1)
        enough = np.take_along_axis(count[nearest], order, axis=1).cumsum(axis=1) > least
        core[at] = np.take_along_axis(np.take_along_axis(near, order, axis=1), enough.argmax(axis=1)[:, None], axis=1)[:, 0]
    best, near, seen, nxt = np.full(m, np.inf), np.zeros(m, int), np.zeros(m, bool), members[following]
    out, a, b = np.empty(n - 1), np.empty(n - 1, int), np.empty(n - 1, int)
    point, k = 0, kind[0]
    for e in range(n - 1):  # Prim's tree
        following[k] += 1
        nxt[k] = members[following[k]] if following[k] < ends[k] else n
        if not seen[k]:
            seen[k] = True
            reach = np.maximum(np.maximum(core[k], core), apart(k))
            reach[k] = core[k]
            closer = (nxt < n) & (reach < best)
            best[closer], near[closer] = reach[closer], point
        if nxt[k] == n:
            best[k] = np.inf
        low = best.min()
        tied = np.flatnonzero(best == low)
        k = tied[nxt[tied].argmin()]
        point = nxt[k]
        out[e], a[e], b[e] = low, near[k], point
    order = np.lexsort((b, a, out))
    return out[order], a[order], b[order]


def density_clusters(points: np.ndarray, least: int) -> np.ndarray:
    """Labels by hierarchical density clustering (excess of mass over the mutual-reachability tree); -1 is noise.

    Memory is linear in the points, time quadratic in the different ones.
    """
    n = len(points)
    if n < least + 1:
        return np.full(n, -1)
    edges = zip(*(x.tolist() for x in density_tree(points, least)))
    parent, node, size, kids = list(range(n)), list(range(n)), {i: 1 for i in range(n)}, {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for w, a, b in edges:
        ra, rb = find(a), find(b)
        new = n + len(kids)
        kids[new] = (node[ra], node[rb], w)
        size[new] = size[node[ra]] + size[node[rb]]
        parent[rb] = ra
        node[ra] = new

    def leaves(x: int) -> list[int]:
        out, stack = [], [x]
        while stack:
            y = stack.pop()
            if y < n:
                out.append(y)
            else:
                stack += kids[y][:2]
        return out

    labels, chosen = np.full(n, -1), []
    root = n + len(kids) - 1
    # Condense: a cluster lives on while splits only shed fewer than ``least`` points; its stability is the mass of its stay.
    births, order, stay = {root: 0.0}, [], {}
    stack = [root]
    children: dict[int, list[int]] = {}
    while stack:
        c = stack.pop()
        order.append(c)
        mass, x, born = 0.0, c, births[c]
        children[c] = []
        while x >= n:
            a, b, w = kids[x]
            lam = 1.0 / max(w, 1e-12)
            big = [y for y in (a, b) if size[y] >= least]
            if len(big) == 2:
                mass += size[x] * (lam - born)
                for y in big:
                    births[y] = lam
                    children[c].append(y)
                    stack.append(y)
                break
            if not big:
                mass += size[x] * (lam - born)
                break
            mass += (size[x] - size[big[0]]) * (lam - born)
            x = big[0]
        stay[c] = mass
    value: dict[int, float] = {}
    take: dict[int, bool] = {}
    for c in reversed(order):
        below = sum(value[k] for k in children[c])
        take[c] = c != root and stay[c] >= below
        value[c] = stay[c] if take[c] else below
    stack = [root]
    while stack:
        c = stack.pop()
        if take[c]:
            chosen.append(c)
        else:
            stack += children[c]
    for i, c in enumerate(sorted(chosen, key=lambda c: min(leaves(c)))):
        labels[leaves(c)] = i
    return labels


def clustered(vectors: DataFrame, scope: str, item: str, vector: str, least: int) -> DataFrame:
    """(scope, item, cluster): density clusters within each scope, one tree for all of its items, -1 for noise."""
    kind = dict(vectors.dtypes)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(item)
        labels = density_clusters(np.stack(rows[vector].to_numpy()), least)
        return pd.DataFrame({scope: rows[scope].to_numpy(), item: rows[item].to_numpy(), "cluster": labels})

    return vectors.select(scope, item, vector).groupBy(scope).applyInPandas(of, f"{scope} {kind[scope]}, {item} {kind[item]}, cluster long")


def principal(points: np.ndarray, most: int = 10) -> np.ndarray:
    """Points on their first principal axes, at most ``most``."""
    centred = points - points.mean(axis=0)
    wide = len(points) < points.shape[1]
    axes = np.linalg.svd(centred, full_matrices=False)[2] if wide else np.linalg.eigh(centred.T @ centred)[1].T[::-1]
    return centred @ axes[:most].T


def squared_distances(points: np.ndarray, block: int = 1_000):
    """The squared distance of each pair once, block against block."""
    for a in range(0, len(points), block):
        for b in range(a, len(points), block):
            x, y = points[a : a + block], points[b : b + block]
            sq = sum((x[:, None, k] - y[None, :, k]) ** 2 for k in range(points.shape[1]))
            yield sq[np.triu_indices(len(x), 1)] if a == b else sq.ravel()


def pair_median(points: np.ndarray, room: int = 4_000_000) -> float:
    """The exact median of all pairs' squared distances; no more than ``room`` of them, or a block, are held at a time.

    Numbers that aren't negative sort as their bits do, so passes over the pairs settle 16 bits each until few enough are left.
    """
    pairs = len(points) * (len(points) - 1) // 2

    def at(rank: int) -> float:
        shift, prefix, inside = 64, 0, pairs
        while inside > room and shift:
            shift -= 16
            counts = np.zeros(1 << 16, dtype=np.int64)
            for sq in squared_distances(points):
                bits = sq.view(np.int64)
                counts += np.bincount((bits[bits >> min(63, shift + 16) == prefix] >> shift) & 0xFFFF, minlength=1 << 16)
            upto = counts.cumsum()
            digit = int(np.searchsorted(upto, rank, side="right"))
            rank, inside, prefix = rank - int(upto[digit] - counts[digit]), int(counts[digit]), prefix << 16 | digit
        if inside > room:  # all of one value
            return float(np.int64(prefix).view(np.float64))
        left = np.concatenate([sq[sq.view(np.int64) >> min(63, shift) == prefix] for sq in squared_distances(points)])
        return float(np.partition(left, rank)[rank])

    low = at((pairs - 1) // 2)
    return low if pairs % 2 else (low + at(pairs // 2)) / 2


def change_points(points: np.ndarray, penalty: float) -> list[int]:
    """Starts of new segments by pruned exact linear time search with a Gaussian-kernel cost; none for fewer than four points.

    The kernel's width is the median of all pairs, its exponent is kept within 0.01 and 100 as in the method's usual
    implementation. The sums that costs need grow with each point, so memory is linear in the points.
    """
    n = len(points)
    if n < 4:
        return []
    width = pair_median(points)
    gamma = 1.0 / width if width else 1.0
    columns = np.ascontiguousarray(points.T)
    block = np.zeros(n + 1)  # block[s]: sum of the kernel over all pairs of points from s to before t
    best, came, live = np.full(n + 1, np.inf), np.zeros(n + 1, int), np.array([0])
    best[0] = -penalty
    for t in range(1, n + 1):
        first = live[0]
        apart = columns[:, first : t - 1] - columns[:, t - 1 : t]
        near = np.exp(-np.clip(gamma * np.einsum("ij,ij->j", apart, apart), 1e-2, 1e2))
        block[first : t - 1] += 2 * near[::-1].cumsum()[::-1]
        block[first:t] += 1
        values = best[live] + (t - live) - block[live] / (t - live) + penalty
        k = int(values.argmin())
        best[t], came[t] = values[k], live[k]
        live = np.append(live[values - penalty <= best[t]], t)
    out, t = [], n
    while t > 0:
        t = int(came[t])
        if t:
            out.append(t)
    return out[::-1]


def change_boundaries(vectors: DataFrame, scope: str, seq: str, vector: str) -> DataFrame:
    """(scope, seq): first rows of new segments of each scope, searched over its whole sequence after a reduction to ten
    principal axes. A scope is one task, its memory linear and its time at most quadratic in the scope's rows."""
    kind = dict(vectors.dtypes)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(seq).reset_index(drop=True)
        points = np.stack(rows[vector].to_numpy()).astype(float)
        at = change_points(principal(points), max(5, len(points) // 5))
        return rows.loc[at, [scope, seq]]

    return vectors.select(scope, seq, vector).groupBy(scope).applyInPandas(of, f"{scope} {kind[scope]}, {seq} {kind[seq]}")
