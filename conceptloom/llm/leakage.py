"""Evaluation texts in a corpus, by shared-token seeds and greedy string tiling."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptloom.runtime import Scratch

#: Words that must run on in both texts, and words of the shortest tile that counts to the coverage.
SEED_WORDS, TILE_WORDS = 10, 5
#: Bits of the filter through which windows of the corpus must pass before they are shuffled: 128 KB to 16 MB. A window sets four of
#: them, read off its hash at these places; with 64 bits to a window about one other window in 80,000 passes.
MIN_BITS, MAX_BITS, PER_WINDOW, PLACES = 1 << 20, 1 << 27, 64, (0, 13, 26, 37)
#: Base of the rolling hash over 64-bit word codes: a fixed odd number.
BASE = 0x9E3779B97F4A7C15
CHUNK_CHARS, KNOWN_WORDS = 2_000_000, 2_000_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Maximal runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower())


class Windows:
    """Rolling hashes of all runs of ``size`` words of many texts, computed at once."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.codes: dict[str, int] = {}

    def code(self, words: list[str]) -> np.ndarray:
        if len(self.codes) > KNOWN_WORDS:
            self.codes.clear()
        known = self.codes
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, hash) of each window; windows never run from one text into the next."""
        lists = [words_of(t) for t in texts]
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        codes = self.code([w for x in lists for w in x])
        n = len(codes) - self.size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        h = codes[:n].copy()
        for j in range(1, self.size):
            h = h * np.uint64(BASE) + codes[j : j + n]
        h ^= h >> np.uint64(29)
        owner = np.repeat(np.arange(len(texts)), counts)
        inside = owner[:n] == owner[self.size - 1 :]
        return owner[:n][inside], h[inside].view(np.int64)


_POWER = np.uint64(0x5851F42D4C957F2D)  # base of the hashes inside the tiling, odd


def _prefixes(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running hashes of a sequence and the powers that take a part of it out again."""
    with np.errstate(over="ignore"):
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(seq), _POWER))])
        inverse = np.uint64(pow(int(_POWER), -1, 1 << 64))
        shrunk = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(seq), inverse))])
        return np.concatenate([[np.uint64(0)], np.cumsum(seq * shrunk[1:])]), power


def _same_run(x: np.ndarray, y: np.ndarray, free_x: np.ndarray, free_y: np.ndarray, i: int, j: int) -> int:
    """How far two unmarked runs go on alike, found in doubling steps."""
    k, step = 0, 64
    most = min(len(x) - i, len(y) - j)
    while k < most:
        n = min(step, most - k)
        a, b = slice(i + k, i + k + n), slice(j + k, j + k + n)
        stop = np.flatnonzero((x[a] != y[b]) | ~free_x[a] | ~free_y[b])
        if len(stop):
            return k + int(stop[0])
        k, step = k + n, step * 2
    return k


def tiles(a: list[str], b: list[str], least: int = TILE_WORDS, first: int = 20) -> list[tuple[int, int, int]]:
    """Greedy string tiling of word lists: (start in a, start in b, length), non-overlapping in both.

    Running Karp-Rabin: for a search length, running hashes give those of the unmarked windows; the ones of b are looked up
    by those of a and matches extended. A match that goes on to the left is part of a longer one and left out, so text that
    repeats itself gives as many matches as words, not as pairs of words. Much longer matches restart the search at their
    length; the longest are marked first; then the search length shrinks to ``least``. So the first tile is the longest run
    that both share.
    """
    number: dict[str, int] = {}
    x, y = (np.array([number.setdefault(w, len(number) + 1) for w in words], dtype=np.uint64) for words in (a, b))
    free_x, free_y = np.ones(len(x), dtype=bool), np.ones(len(y), dtype=bool)
    hash_x, power = _prefixes(x)
    hash_y, power_y = _prefixes(y)
    found: list[tuple[int, int, int]] = []

    def windows(h: np.ndarray, power: np.ndarray, free: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(free) - s + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        taken = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(taken[s:] == taken[:-s])
        with np.errstate(over="ignore"):
            return at, (h[at + s] - h[at]) * power[at]

    s = max(first, least)
    while True:
        at_x, own = windows(hash_x, power, free_x, s)
        at_y, theirs = windows(hash_y, power_y, free_y, s)
        order = np.argsort(theirs, kind="stable")
        theirs = theirs[order]
        low, high = np.searchsorted(theirs, own), np.searchsorted(theirs, own, side="right")
        matches, longest = [], 0
        for k in np.flatnonzero(high > low):
            i, js = int(at_x[k]), at_y[order[low[k] : high[k]]]
            if i and free_x[i - 1]:
                js = js[(js == 0) | (y[js - 1] != x[i - 1]) | ~free_y[js - 1]]
            for j in js:
                run = _same_run(x, y, free_x, free_y, i, int(j))
                if run >= s:
                    matches.append((run, i, int(j)))
                    longest = max(longest, run)
        if longest > 2 * s:
            s = longest
            continue
        again = False
        for run, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if free_x[i : i + run].all() and free_y[j : j + run].all():
                free_x[i : i + run] = free_y[j : j + run] = False
                found.append((i, j, run))
            else:
                again = True  # a part of it may still be free
        if again and matches:
            continue
        if s <= least:
            return found
        s = max(least, s // 2)


def filter_size(n: int) -> int:
    """Bits of a filter for n windows: PER_WINDOW for each, a power of two, between MIN_BITS and MAX_BITS."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (PER_WINDOW * max(1, n) - 1).bit_length()))


def _filter_bits(seeds: DataFrame, bits: int) -> np.ndarray:
    """The filter as words of 64 bits; what comes to the driver has at most bits / 64 rows, however many seeds there are."""
    at = F.col("at")
    rows = seeds.select(F.explode(F.array(*[F.shiftrightunsigned("h", k).bitwiseAND(F.lit(bits - 1)) for k in PLACES])).alias("at")).select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(63).alias("bit")).select("word", F.expr("shiftleft(1L, cast(bit as int))").alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def leaks(documents: DataFrame, items: DataFrame, run_words: int = SEED_WORDS, tile_words: int = TILE_WORDS, least_coverage: float | None = None, filter_bits: int | None = None) -> DataFrame:
    """Pairs of a document (doc_id, text) and an evaluation item (item_id, text) that share a run of ``run_words`` words:
    (item_id, doc_id, longest_run, n_tiles, covered_words, item_words, coverage). With ``least_coverage`` also pairs whose
    tiles of ``tile_words`` or more cover so large a share of the item, in whatever order they stand.

    Every window of every document passes a filter built from the items' windows; the rest, few, are joined with the items'
    windows by hash. Windows are as long as a run, or with a coverage as long as a tile: then a pair goes on if it shares as
    many different windows as a run has, or so many that they could cover the share (a tile of k words has k - tile_words + 1
    windows, so n windows cover tile_words * n words at most). For the pairs so seeded, greedy string tiling marks the longest
    common runs down to ``tile_words``, which verifies the words themselves, and the thresholds decide. Null and empty texts
    share nothing; copies of a text under other ids each count; repeat rows of an id are one row.
    """
    seed_words = run_words if least_coverage is None else tile_words
    scratch = Scratch(documents.sparkSession, "leaks")
    doc_kind, item_kind = dict(documents.dtypes)["doc_id"], dict(items.dtypes)["item_id"]

    def item_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = Windows(seed_words)
        for rows in batches:
            owner, h = w.of(rows["text"].tolist())
            size = np.array([len(words_of(t)) for t in rows["text"]], dtype=np.int32)
            yield pd.DataFrame({"item_id": rows["item_id"].to_numpy()[owner], "h": h, "size": size[owner]})

    tests = items.select("item_id", "text").dropna().dropDuplicates(["item_id"])
    seeds = scratch.save(tests.mapInPandas(item_windows, f"item_id {item_kind}, h long, size int").distinct(), "seeds")
    filter_bits = filter_bits or filter_size(seeds.count())
    shared = documents.sparkSession.sparkContext.broadcast(_filter_bits(seeds, filter_bits))

    def passing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, bits = Windows(seed_words), shared.value

        def some(rows: pd.DataFrame) -> pd.DataFrame:
            owner, h = w.of(rows["text"].tolist())
            hit = np.ones(len(h), dtype=bool)
            for k in PLACES:
                at = (h.view(np.uint64) >> np.uint64(k)) & np.uint64(filter_bits - 1)
                hit &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
            owner, h = owner[hit], h[hit]
            which, first = np.unique(owner, return_index=True)
            out = rows.iloc[which].copy()
            out["hits"] = pd.Series([np.unique(x) for x in np.split(h, first[1:])] if len(which) else [], index=out.index, dtype=object)
            return out[["doc_id", "text", "hits"]]

        for rows in batches:
            part = (rows["text"].str.len().cumsum() // CHUNK_CHARS).to_numpy()
            for k in np.unique(part):
                yield some(rows[part == k])

    corpus = documents.select("doc_id", "text").filter(F.col("text") != "")
    hits = scratch.save(corpus.mapInPandas(passing, f"doc_id {doc_kind}, text string, hits array<long>"), "hits")
    met = hits.select("doc_id", F.explode("hits").alias("h")).join(seeds, "h")
    if least_coverage is None:
        pairs = met.select("item_id", "doc_id").distinct()
    else:
        shared_by = met.groupBy("item_id", "doc_id").agg(F.count_distinct("h").alias("n"), F.max("size").alias("size"))
        pairs = shared_by.filter((F.col("n") > run_words - tile_words) | (F.col("n") * tile_words >= F.lit(least_coverage) * F.col("size"))).select("item_id", "doc_id")
    texts = pairs.join(hits.select("doc_id", F.col("text").alias("doc_text")).dropDuplicates(["doc_id"]), "doc_id").join(tests.withColumnRenamed("text", "item_text"), "item_id")

    def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                a = words_of(r.item_text)
                t = tiles(a, words_of(r.doc_text), tile_words)
                longest, covered = max((k for *_, k in t), default=0), sum(k for *_, k in t)
                if longest >= run_words or (least_coverage is not None and covered >= least_coverage * len(a)):
                    out.append((r.item_id, r.doc_id, longest, len(t), covered, len(a), covered / len(a)))
            yield pd.DataFrame(out, columns=["item_id", "doc_id", "longest_run", "n_tiles", "covered_words", "item_words", "coverage"])

    return texts.select("item_id", "doc_id", "item_text", "doc_text").mapInPandas(
        tiled, f"item_id {item_kind}, doc_id {doc_kind}, longest_run int, n_tiles int, covered_words int, item_words int, coverage double"
    )
