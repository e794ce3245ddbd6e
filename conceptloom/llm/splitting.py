"""Splitting oversized items at natural boundaries by pointer doubling."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 2000, 100
#: Characters of text whose boundary tables are worked on at a time in one task.
BATCH_CHARS = 4_000_000

# Where text pauses: the end of a line, a stop or a clause mark (before white space in scripts that write it), a word's end.
_STOP = re.compile(r"(?=\n)(?<!\n)|[.!?…][\"'”’»)\]]*(?=\s|$)|[।॥][\"'”’»)\]]*|[。！？][”’」』）]*")
_CLAUSE = re.compile(r"[,;:](?=\s|$)|(?<=\s)[—–](?=\s)|[，；：、]")
_WORD_END = re.compile(r"(?<=\S)(?=\s)")
_WORD_START = re.compile(r"(?<=\s)(?=\S)")
KINDS = np.array(["stop", "clause", "space", "hard", "end"])


def _ends(pattern: re.Pattern, text: str) -> np.ndarray:
    return np.fromiter((m.end() for m in pattern.finditer(text)), dtype=np.int64)


def _off_mark(text: str, at: int) -> int:
    """A cut without any pause at least keeps a letter and its marks together."""
    low = max(0, at - 8)
    while at > low and at < len(text) and unicodedata.category(text[at])[0] == "M":
        at -= 1
    return at


class _Table:
    """Boundaries of many texts, one after another on one line of positions."""

    def __init__(self, texts: list[str], limit: int, overlap: int) -> None:
        self.base = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        at, kind, begins, last = [], [], [], []
        for i, text in enumerate(texts):
            levels = [_ends(p, text) for p in (_STOP, _CLAUSE, _WORD_END)]
            n = len(text)
            p = np.concatenate([[0, n], *levels])
            k = np.concatenate([[0, 4], *[np.full(len(x), j) for j, x in enumerate(levels)]])
            order = np.lexsort((k, p))
            p, k = p[order], k[order]
            keep = np.append(True, p[1:] != p[:-1])
            p, k = p[keep], k[keep]
            k[p == n] = 4
            # Each boundary's piece begins at the first word that starts at most ``overlap`` before it.
            words = _ends(_WORD_START, text)
            begin = np.maximum(p - overlap, 0)
            if len(words):
                j = np.searchsorted(words, begin)
                word = words[np.minimum(j, len(words) - 1)]
                begin = np.where((j < len(words)) & (word <= p - overlap // 2), word, begin)
            begin = np.array([_off_mark(text, int(b)) for b in begin], dtype=np.int64)
            begin[p == 0] = 0
            # Where the next pause lies beyond the limit, cuts come at the limit itself, one after another.
            hard = []
            for w in np.flatnonzero(p[1:] - begin[:-1] > limit):
                x = int(begin[w])
                while x + limit < p[w + 1]:
                    cut = _off_mark(text, x + limit)
                    x = _off_mark(text, cut - overlap)
                    hard.append((cut, x))
            if hard:
                p, k, begin = np.concatenate([p, [c for c, _ in hard]]), np.concatenate([k, np.full(len(hard), 3)]), np.concatenate([begin, [x for _, x in hard]])
                order = np.argsort(p, kind="stable")
                p, k, begin = p[order], k[order], begin[order]
            at.append(p + self.base[i])
            kind.append(k)
            begins.append(begin + self.base[i])
            last.append(np.full(len(p), n + self.base[i]))
        self.at, self.kind, self.begin, last = (np.concatenate(x).astype(np.int64) for x in (at, kind, begins, last))
        # Join each boundary with its farthest legal successor: the farthest stop in reach that fills half the limit, else clause
        # mark, else space; without such a pause the farthest of any kind, and only without any a hard cut.
        reach = np.minimum(self.begin + limit, last)
        index = np.arange(len(self.at))
        following = index.copy()
        for level, fill in ((3, 0), (2, 0), (1, 0), (0, 0), (2, limit // 2), (1, limit // 2), (0, limit // 2)):
            rows = np.flatnonzero((self.kind <= level) | (self.kind == 4)) if level < 3 else index
            j = np.searchsorted(self.at[rows], reach, side="right") - 1
            far = rows[np.maximum(j, 0)]
            following = np.where((j >= 0) & (far > index) & (self.at[far] - self.begin >= fill), far, following)
        whole = np.searchsorted(self.at, last)  # what reaches the end of the text ends there
        following = np.where((reach == last) & (whole > index), whole, following)
        self.following = np.where(self.at == last, index, following)

    def cuts(self) -> np.ndarray:
        """Boundaries on the greedy way from the start of each text: in each round the marked ones mark what lies one
        jump on, and the table of jumps is squared, so the way is known after logarithmically many rounds."""
        marked = np.zeros(len(self.at), dtype=bool)
        marked[np.searchsorted(self.at, self.base)] = True
        jump, known = self.following, 0
        while (now := int(marked.sum())) != known:
            known = now
            marked[jump[marked]] = True
            jump = jump[jump]
        return np.flatnonzero(marked)


def split_texts(texts: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> Iterator[tuple[int, int, int, int, int, str]]:
    """(text number, piece number, start, end, overlap, kind of cut) of all pieces of non-empty texts, in order."""
    t = _Table(texts, limit, overlap)
    cuts = t.cuts()
    owner = np.searchsorted(t.base, t.at[cuts], side="right") - 1
    piece = 0
    for c, before, i, old in zip(cuts[1:], cuts[:-1], owner[1:], owner[:-1]):
        if i != old:
            piece = 0
            continue
        piece += 1
        base = t.base[i]
        start, done, end = int(t.begin[before] - base), int(t.at[before] - base), int(t.at[c] - base)
        yield int(i), piece, start, end, done - start, str(KINDS[t.kind[c]])


SCHEMA = "item_table string, item_id string, piece int, start int, `end` int, overlap int, cut string, piece_text string"


def split_items(items: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of the items (item_table, item_id, text) with more than ``limit`` Unicode characters.

    A piece has at most ``limit`` characters. It ends where the text last pauses within reach and beyond half the limit: at a
    sentence or line end, else a clause mark, else white space; without such a pause at the last one of the first half, and
    only without any at the limit itself. It begins up to ``overlap`` characters before the end of the piece before it, at a
    word if one starts there. text[start + overlap : end] of all pieces, joined, is the text. Null and empty texts, and texts up to the limit, give no pieces. Only oversized rows reach
    Python, nothing is shuffled; repeat rows give repeated pieces.
    """
    if not 0 <= overlap <= limit // 2 - 16:
        raise ValueError("overlap must be less than half the limit")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            held, size = [], 0
            for row in rows.itertuples(index=False):
                held.append(row)
                size += len(row.text)
                if size >= BATCH_CHARS:
                    yield of(held)
                    held, size = [], 0
            if held:
                yield of(held)

    def of(rows: list) -> pd.DataFrame:
        out = [(rows[i].item_table, rows[i].item_id, p, a, b, o, kind, rows[i].text[a:b]) for i, p, a, b, o, kind in split_texts([r.text for r in rows], limit, overlap)]
        return pd.DataFrame(out, columns=["item_table", "item_id", "piece", "start", "end", "overlap", "cut", "piece_text"])

    big = items.select("item_table", "item_id", "text").filter(F.char_length("text") > limit)
    return big.mapInPandas(pieces, SCHEMA)


def text_items(units: DataFrame, segments: DataFrame) -> DataFrame:
    """Units and segments as items: item_table, item_id, label (declared language), text."""
    shape = lambda df, name, key, text: df.select(F.lit(name).alias("item_table"), F.col(key).alias("item_id"), F.col("lang").alias("label"), F.col(text).alias("text"))
    return shape(units, "stage3_transcripts", "unit_id", "raw_text").unionByName(shape(segments, "stage5_segments", "segment_id", "merged_text"))
