"""Languages of texts and of the stretches of mixed texts, by segmentation-marginalised unigrams."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary file, and the session setting that names another.
VOCABULARY, VOCABULARY_KEY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken", "spark.conceptloom.vocabulary"
#: Labelled sentences and labelled items read at most to fit the model; EM rounds; share of probability spread evenly over all pieces.
MAX_SAMPLES, MAX_LABELLED, ROUNDS, EVEN = 10_000, 3_000, 6, 0.1
#: Longest run of bytes whose segmentations are summed as one; longer words are summed in runs, when fitted as when scored.
RUN_BYTES = 42
#: A word speaks against a language by so many nats at most; the price of a change of language inside and between sentences.
AGAINST, CHANGE_INSIDE, CHANGE_AT_STOP = 6.0, 14.0, 5.0
#: A stretch holds a full sentence from so many words (or characters of scripts without spaces) and nats of evidence.
SENTENCE_WORDS, SENTENCE_SIGNS, SENTENCE_NATS = 5, 7, 11.0
#: Known words kept in a task's memory, and words and characters of text worked on at a time.
KNOWN_WORDS, CHUNK_CHARS = 500_000, 1_000_000

_PRIME = np.uint64(0x100000001B3)
_HAN = "㐀-䶿一-鿿豈-﫿"
# A long run without spaces (code, addresses); a sign of a script without spaces; a run of letters with their marks; a
# mark that ends a sentence. The first and last are no words.
_TOKEN = re.compile(rf"[!-~]{{40,}}|[{_HAN}]|(?:[^\W\d_{_HAN}]|[̀-ͯऀ-ॣ०-෿])+|[.!?…;।॥。！？；\n]+")
_NO_WORD = re.compile(r"[.!?…;।॥。！？；\n]|[!-~]{40}")
_IS_HAN = re.compile(rf"[{_HAN}]")


def _hash(data: bytes) -> int:
    h = 0
    for b in data:
        h = (h * int(_PRIME) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def read_pieces(path: str = VOCABULARY) -> np.ndarray:
    """Sorted hashes of the pieces of a public vocabulary (one base64 piece and rank a line), single bytes included."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"no vocabulary at {path}: name a .tiktoken file as vocabulary=, or in the setting {VOCABULARY_KEY}")
    with open(path, "rb") as f:
        pieces = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
    pieces |= {bytes([b]) for b in range(256)}
    return np.unique(np.array([_hash(p) for p in pieces], dtype=np.uint64))


def _bytes_of(word: str) -> bytes:
    return word.encode("utf-8", "replace") if _IS_HAN.match(word) else b" " + word.encode("utf-8", "replace")


def _runs(word: str) -> list[bytes]:
    data = _bytes_of(word)
    return [data[k : k + RUN_BYTES] for k in range(0, len(data), RUN_BYTES)]


class Lattice:
    """All segmentations of many words of like length into pieces."""

    def __init__(self, words: list[bytes], hashes: np.ndarray) -> None:
        self.n, self.length = len(words), max(map(len, words))
        raw = np.zeros((self.n, self.length), dtype=np.uint64)
        self.size = np.array([len(w) for w in words])
        for i, w in enumerate(words):
            raw[i, : len(w)] = np.frombuffer(w, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        # piece[l-1][:, i]: number of the piece of l bytes that starts at i, or -1
        self.piece: list[np.ndarray] = []
        h = np.zeros((self.n, self.length), dtype=np.uint64)
        for size in range(1, self.length + 1):  # no piece is longer than a run
            starts = self.length - size + 1
            h = h[:, :starts] * _PRIME + raw[:, size - 1 :]
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            inside = np.arange(starts)[None, :] + size <= self.size[:, None]
            self.piece.append(np.where((hashes[at] == h) & inside, at, -1))
        self.sizes = [k + 1 for k, x in enumerate(self.piece) if (x >= 0).any()]

    def forward(self, p: np.ndarray) -> np.ndarray:
        """alpha[w, i, lang]: probability of the first i bytes of word w, summed over all segmentations. p has a last row of zeros."""
        alpha = np.zeros((self.n, self.length + 1, p.shape[1]))
        alpha[:, 0] = 1.0
        for end in range(1, self.length + 1):
            for size in self.sizes:
                if size > end:
                    break
                ids = self.piece[size - 1][:, end - size]
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    alpha[rows, end] += alpha[rows, end - size] * p[ids[rows]]
        return alpha

    def total(self, p: np.ndarray) -> np.ndarray:
        return self.forward(p)[np.arange(self.n), self.size]

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by language, words weighted by language."""
        alpha = self.forward(p)
        beta = np.zeros_like(alpha)
        beta[np.arange(self.n), self.size] = 1.0
        for start in range(self.length - 1, -1, -1):
            for size in self.sizes:
                if size > self.length - start:
                    break
                ids = self.piece[size - 1][:, start]
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    beta[rows, start] += beta[rows, start + size] * p[ids[rows]]
        z = beta[:, 0]
        uses = np.zeros_like(p)
        for start in range(self.length):
            for size in self.sizes:
                if size > self.length - start:
                    break
                ids = self.piece[size - 1][:, start]
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    np.add.at(uses, ids[rows], weight[rows] * alpha[rows, start] * p[ids[rows]] * beta[rows, start + size] / z[rows])
        return uses


def _by_length(words: list[bytes], step: int = 6, most: int = 4096) -> Iterator[np.ndarray]:
    size = np.array([len(w) for w in words])
    order = np.argsort(size, kind="stable")
    band = size[order] // step
    for b in np.unique(band):
        rows = order[band == b]
        for k in range(0, len(rows), most):
            yield rows[k : k + most]


class Model:
    """Piece probabilities by language: p[piece, language]."""

    def __init__(self, languages: list[str], hashes: np.ndarray, p: np.ndarray) -> None:
        self.languages, self.hashes, self.p = languages, hashes, p

    @classmethod
    def fit(cls, labelled: list[tuple[str, str]], hashes: np.ndarray, rounds: int = ROUNDS) -> Model:
        """Expectation-maximisation over the segmentations of the words of labelled texts (language, text)."""
        languages = sorted({lang for lang, _ in labelled})
        if not languages:
            raise ValueError("no labelled texts")
        counts: dict[str, np.ndarray] = {}
        for lang, text in labelled:
            for w in _TOKEN.findall(text.lower()):
                if not _NO_WORD.match(w):
                    counts.setdefault(w, np.zeros(len(languages)))[languages.index(lang)] += 1
        runs = [(run, n) for w, n in counts.items() for run in _runs(w)]
        words, weight = [run for run, _ in runs], np.array([n for _, n in runs])
        n = len(hashes)
        p = np.full((n + 1, len(languages)), 1.0 / n)
        p[n] = 0.0
        lattices = [(rows, Lattice([words[i] for i in rows], hashes)) for rows in _by_length(words)]
        for _ in range(rounds):
            uses = sum(lattice.expected(p, weight[rows]) for rows, lattice in lattices)
            p = (1 - EVEN) * uses / uses.sum(axis=0) + EVEN / n
            p[n] = 0.0
        return cls(languages, hashes, p)

    def score(self, words: list[str]) -> np.ndarray:
        """Evidence of each word: log probability by language less the best one's, bounded below."""
        runs, owner = [], []
        for i, w in enumerate(words):
            for run in _runs(w):
                runs.append(run)
                owner.append(i)
        total = np.empty((len(runs), len(self.languages)))
        for rows in _by_length(runs):
            total[rows] = np.log(Lattice([runs[i] for i in rows], self.hashes).total(self.p))
        out = np.zeros((len(words), len(self.languages)))
        np.add.at(out, np.array(owner, dtype=np.int64), total)
        return np.maximum(out - out.max(axis=1, keepdims=True), -AGAINST)


class Detector:
    """Finds the stretches of texts; remembers the words it has scored."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.evidence = np.empty((0, len(self.model.languages)))
        self.word = np.empty(0, dtype=bool)  # false for what ends a sentence
        self.sign = np.empty(0, dtype=bool)

    def _ids(self, tokens: list[str]) -> np.ndarray:
        new = list(set(tokens).difference(self.known))
        if new:
            if len(self.known) + len(new) > KNOWN_WORDS:
                self.forget()
                new = list(set(tokens))
            word = np.array([_NO_WORD.match(w) is None for w in new], dtype=bool)
            evidence = np.zeros((len(new), self.evidence.shape[1]))
            evidence[word] = self.model.score([w for w, is_word in zip(new, word) if is_word])
            self.evidence = np.concatenate([self.evidence, evidence])
            self.word = np.concatenate([self.word, word])
            self.sign = np.concatenate([self.sign, np.array([_IS_HAN.match(w) is not None for w in new], dtype=bool)])
            base = len(self.known)
            self.known.update({w: base + i for i, w in enumerate(new)})
        return np.fromiter(map(self.known.__getitem__, tokens), dtype=np.int64, count=len(tokens))

    def stretches(self, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
        """For each text its stretches that hold a full sentence: (first token, end token, language number, confidence)."""
        lists = [_TOKEN.findall(t.lower()) for t in texts]
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        out: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
        full = np.flatnonzero(counts)
        if not len(full):
            return out
        ids = self._ids([w for x in lists for w in x])
        e, word, sign = self.evidence[ids], self.word[ids], self.sign[ids]
        ends = np.cumsum(counts)
        begins = ends - counts
        best = np.add.reduceat(e, begins[full], axis=0).argmax(axis=1)
        owner = np.repeat(np.arange(len(full)), counts[full])
        # How much any stretch speaks for another language than the text's best: running sums above their minimum so far.
        # Every text is shifted below the ones before it, so that minima never reach back.
        gain = e - e[np.arange(len(e)), best[owner]][:, None]
        run = np.cumsum(gain, axis=0)
        run -= run[begins[full]][owner] - gain[begins[full]][owner]
        run -= owner[:, None] * (2 * AGAINST * (int(counts.max()) + 1))
        before = np.minimum.accumulate(run - gain, axis=0)
        mixed = np.maximum.reduceat((run - before).max(axis=1), begins[full]) >= SENTENCE_NATS
        for k in np.flatnonzero(~mixed):
            i = full[k]
            out[i] = self._kept([(0, int(counts[i]), int(best[k]))], e[begins[i] : ends[i]], word[begins[i] : ends[i]], sign[begins[i] : ends[i]])
        todo = full[mixed]
        todo = todo[np.argsort(counts[todo], kind="stable")]
        for k in range(0, len(todo), 256):
            rows = todo[k : k + 256]
            for i, path in zip(rows, self._paths(e, ~word, begins[rows], counts[rows])):
                cut = np.flatnonzero(np.diff(path)) + 1
                edges = [0, *cut.tolist(), len(path)]
                out[i] = self._kept([(a, b, int(path[a])) for a, b in zip(edges, edges[1:])], e[begins[i] : ends[i]], word[begins[i] : ends[i]], sign[begins[i] : ends[i]])
        return out

    def _paths(self, e: np.ndarray, stop: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """Most likely languages of the words of each text, where a change has a price (Viterbi, many texts at a time)."""
        n, most, langs = len(begins), int(counts.max()), e.shape[1]
        score, came = np.zeros((n, langs)), np.zeros((most, n, langs), dtype=np.int8)
        final = np.zeros((n, langs))
        stay = np.arange(langs)[None, :]
        for t in range(most):
            at = np.minimum(begins + t, len(e) - 1)
            if t:
                top = score.argmax(axis=1)
                change = score[np.arange(n), top] - np.where(stop[at - 1], CHANGE_AT_STOP, CHANGE_INSIDE)
                moved = change[:, None] > score
                came[t] = np.where(moved, top[:, None], stay)
                score = np.where(moved, change[:, None], score)
            score = score + e[at]
            done = counts == t + 1
            final[done] = score[done]
        paths = []
        for i in range(n):
            path = np.empty(counts[i], dtype=np.int8)
            lang = int(final[i].argmax())
            for t in range(int(counts[i]) - 1, -1, -1):
                path[t] = lang
                lang = came[t, i, lang] if t else lang
            paths.append(path)
        return paths

    def _kept(self, parts: list[tuple[int, int, int]], e: np.ndarray, word: np.ndarray, sign: np.ndarray) -> list[tuple[int, int, int, float]]:
        """The parts that hold a sentence; what lies between is added to the part before it, equal neighbours are joined."""
        kept: list[list] = []
        for a, b, lang in parts:
            sums = e[a:b].sum(axis=0)
            margin = float(sums[lang] - np.delete(sums, lang).max())
            signs = int(sign[a:b].sum())
            if margin < SENTENCE_NATS or (signs < SENTENCE_SIGNS and int(word[a:b].sum()) - signs < SENTENCE_WORDS):
                continue
            sure = 1.0 / float(np.exp(np.maximum(sums - sums[lang], -700)).sum())
            if kept and kept[-1][2] == lang:
                kept[-1][1], kept[-1][3] = b, max(kept[-1][3], sure)
            else:
                kept.append([a, b, lang, sure])
        return [tuple(x) for x in kept]


def drawn_samples(samples: DataFrame, most: int = MAX_SAMPLES) -> list[tuple[str, str]]:
    """At most ``most`` labelled rows (lang, text), as many of each language, by a hash of their text, so that the order of the
    table and its labels doesn't matter; a language with fewer has all of its rows in."""
    rows = samples.select("lang", "text").dropna()
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(1_000).collect()}
    if not counts:
        return []
    each = max(1, most // len(counts))
    # A share of the hash range of each language that holds about half as many again as wanted.
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(-(2.0**63) + min(1.0, 1.5 * each / n) * 2.0**64))])
    h = F.xxhash64("lang", "text")
    drawn = rows.withColumn("h", h).filter(F.col("h").cast("double") <= share[F.col("lang")]).orderBy("h", "text").limit(2 * most).collect()
    taken: dict[str, int] = {}
    out = []
    for r in drawn:
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= each:
            out.append((r["lang"], r["text"]))
    return out


def fit_model(samples: DataFrame, items: DataFrame | None = None, vocabulary: str | None = None) -> Model:
    """Fit on labelled rows (lang, text), at most MAX_SAMPLES of them, as many of each language.

    With items (item_id, label, text), the model so fitted reads up to MAX_LABELLED of their labelled rows, drawn by a hash
    of their id, keeps those that it finds to be wholly in the language of their label, and is fitted on both. Without any
    labelled sentence the model knows no language, and nothing is detected.
    """
    labelled, hashes = drawn_samples(samples), read_pieces(vocabulary or samples.sparkSession.conf.get(VOCABULARY_KEY, VOCABULARY))
    if not labelled:
        return Model([], hashes, np.empty((0, 0)))
    model = Model.fit(labelled, hashes)
    if items is None:
        return model
    rows = items.filter(F.col("label") != "")
    # A share of the hash range that holds about half as many again as wanted, so that what is sent stays bounded.
    share = min(1.0, 1.5 * MAX_LABELLED / max(1, rows.select("label").count()))
    h = F.xxhash64("item_table", "item_id")
    drawn = rows.filter(h.cast("double") < F.lit(-(2.0**63) + share * 2.0**64)).select("label", "text", h.alias("h")).dropna().orderBy("h").limit(MAX_LABELLED).collect()
    found = Detector(model).stretches([r["text"] for r in drawn])
    agreed = [(label_form(r["label"]), r["text"]) for r, f in zip(drawn, found) if len(f) == 1 and model.languages[f[0][2]] == label_form(r["label"])]
    return Model.fit(labelled + agreed, hashes)


def _detected(items: DataFrame, model: Model, schema: str, rows_of) -> DataFrame:
    shared = items.sparkSession.sparkContext.broadcast((model.languages, model.hashes, model.p))

    def detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = Detector(Model(*shared.value))
        columns = [c.split()[0] for c in schema.split(", ")]
        for rows in batches:
            part = (rows["text"].str.len().cumsum() // CHUNK_CHARS).to_numpy()
            for k in np.unique(part):
                some = rows[part == k]
                texts = some["text"].tolist()
                out = [x for row, text, found in zip(some.itertuples(index=False), texts, detector.stretches(texts)) for x in rows_of(row, text, found, detector.model.languages)]
                yield pd.DataFrame(out, columns=columns)

    if not model.languages:
        return items.sparkSession.createDataFrame([], schema)
    wanted = [c for c in ("item_table", "item_id", "label", "text") if c in items.columns]
    return items.filter(F.col("text") != "").select(*wanted).mapInPandas(detect, schema)


def label_form(label: str | None) -> str | None:
    return None if label is None else re.split("[-_]", label.lower(), maxsplit=1)[0]


def detect_segments(items: DataFrame, model: Model) -> DataFrame:
    """Stretches of one language in each text: (item_table, item_id, segment, start, end, lang, confidence).

    A text is cut into runs of letters; a forward algorithm sums each run's probability over all its segmentations into
    pieces of a public vocabulary, by language, and the most likely sequence of languages, in which changes have a
    price, gives the stretches. Those without a full sentence (names, abbreviations, field marks) are no stretches of their
    own. confidence is the posterior of the language among those of the model. start and end are character positions;
    the stretches of a text cover it. Null and empty texts, and texts without a sentence, have none.
    """

    def rows_of(row, text, found, languages):
        if len(found) == 1:
            yield row.item_table, row.item_id, 0, 0, len(text), languages[found[0][2]], found[0][3]
        elif found:
            spans = [m.start() for m in _TOKEN.finditer(text)]
            # lower case may change what is a token; numbers then end at the last one
            starts = [0, *[spans[min(a, len(spans) - 1)] for a, *_ in found[1:]]]
            for k, (_, _, lang, sure) in enumerate(found):
                yield row.item_table, row.item_id, k, starts[k], starts[k + 1] if k + 1 < len(found) else len(text), languages[lang], sure

    return _detected(items, model, "item_table string, item_id string, segment int, start int, end int, lang string, confidence double", rows_of)


def mislabelled(items: DataFrame, model: Model) -> DataFrame:
    """(item_table, item_id, lang, label, confidence) of each language in a text (label) whose label isn't just that language.

    A label counts in lower case, cut before the first '-' or '_'. A text in several languages is always a case, one
    without any full sentence never. Repeat rows give repeated rows.
    """

    def rows_of(row, text, found, languages):
        sure: dict[str, float] = {}
        for _, _, lang, c in found:
            sure[languages[lang]] = max(c, sure.get(languages[lang], 0.0))
        if sure and (len(sure) > 1 or label_form(row.label) not in sure):
            for lang, c in sure.items():
                yield row.item_table, row.item_id, lang, row.label, c

    return _detected(items, model, "item_table string, item_id string, lang string, label string, confidence double", rows_of)
