import numpy as np
import pytest

from conceptloom.llm import language as g


@pytest.fixture(scope="module")
def samples(spark, sf):
    return spark.read.parquet(f"{sf}/lang_samples.parquet")


@pytest.fixture(scope="module")
def model(samples):
    return g.fit_model(samples)


def test_forward_sums_all_segmentations():
    hashes = np.unique(np.array([g._hash(p) for p in (b"a", b"b", b"ab", b"ba", b"aba")], dtype=np.uint64))
    p = np.zeros((len(hashes) + 1, 1))
    value = {b"a": 0.3, b"b": 0.2, b"ab": 0.1, b"ba": 0.15, b"aba": 0.05}
    for piece, v in value.items():
        p[np.searchsorted(hashes, np.uint64(g._hash(piece))), 0] = v

    def total(w):
        return 1.0 if not w else sum(v * total(w[len(x) :]) for x, v in value.items() if w.startswith(x))

    words = [b"abab", b"a", b"abaab", b"bb"]
    assert g.Lattice(words, hashes).total(p)[:, 0] == pytest.approx([total(w) for w in words])
    uses = g.Lattice([b"ab"], hashes).expected(p, np.ones((1, 1)))[:, 0]
    assert uses[np.searchsorted(hashes, np.uint64(g._hash(b"ab")))] == pytest.approx(0.1 / (0.1 + 0.06))


def test_held_out_accuracy(samples):
    rows = [(r.lang, r.text) for r in samples.orderBy("sample_id").collect()]
    train, test = [x for i, x in enumerate(rows) if i % 5], [x for i, x in enumerate(rows) if not i % 5]
    d = g.Detector(g.Model.fit(train, g.read_pieces()))
    found = d.stretches([t for _, t in test])
    right = sum(len(f) == 1 and d.model.languages[f[0][2]] == lang for (lang, _), f in zip(test, found))
    assert right >= 0.9 * len(test)


def items(spark, rows):
    return spark.createDataFrame([("t", str(i), label, text, "clash", 0) for i, (label, text) in enumerate(rows)], "item_table string, item_id string, label string, text string, lang string, segment int")


EN = "The slow pendulum doubles the energy of the system which we will prove tomorrow."
DE = "Der kleine Strom verdoppelt die Dicke des Glases und das ist schon der ganze Gedanke."


def test_mislabelled(spark, model):
    rows = [("en", EN), ("EN_us", EN), ("en-GB", EN), ("de", EN), (None, EN), ("", EN), ("en", EN + " " + DE), ("en", "x = 2, y = 5"), ("en", None), ("en", ""), ("en", "Q: [...] Fig. 3"), ("de", DE * 3000), ("zz", "QmFzZTY0" * 400)]
    got = {(int(r.item_id), r.lang) for r in g.mislabelled(items(spark, rows), model).collect()}
    assert got == {(3, "en"), (4, "en"), (5, "en"), (6, "en"), (6, "de")}


def test_segments_cover_the_text(spark, model):
    text = f"{EN} {DE}\n{EN.lower().replace('.', '')}"
    got = g.detect_segments(items(spark, [("en", text), ("de", DE), ("x", "1 2 3")]), model).orderBy("item_id", "segment").collect()
    assert [(r.item_id, r.lang) for r in got] == [("0", "en"), ("0", "de"), ("0", "en"), ("1", "de")]
    assert got[0].start == 0 and all(a.end == b.start for a, b in zip(got[:3], got[1:3])) and got[2].end == len(text)
    assert text[got[1].start :].startswith("Der kleine") and all(0.9 < r.confidence <= 1 for r in got)


def test_fit_on_items_and_empty(spark, samples, model):
    few = items(spark, [("en", EN)] * 3 + [("de", EN), (None, DE)])
    assert g.fit_model(samples, few).languages == model.languages
    assert g.mislabelled(few.filter("false"), model).count() == 0
    assert g.mislabelled(few, g.fit_model(samples.filter("false"))).count() == 0


def test_forgetting_words_changes_nothing(model, monkeypatch):
    texts = [EN, DE, EN + DE] * 5
    whole = g.Detector(model).stretches(texts)
    monkeypatch.setattr(g, "KNOWN_WORDS", 20)
    d = g.Detector(model)
    assert [x for t in texts for x in d.stretches([t])] == whole


def test_mixed_stretches_of_sentences_never_seen(samples):
    """Texts of two languages put together from held-out sentences: both must come out. The recall is the figure in README."""
    rows = [(r.lang, r.text) for r in samples.orderBy("sample_id").collect()]
    right = total = wrong = 0
    for fold in range(5):
        train, test = [x for i, x in enumerate(rows) if i % 5 != fold], [x for i, x in enumerate(rows) if i % 5 == fold]
        d = g.Detector(g.Model.fit(train, g.read_pieces()))
        mixed = [(a, b) for i, a in enumerate(test) for b in test[i + 1 :: 6] if a[0] != b[0]]
        for (a, b), found in zip(mixed, d.stretches([f"{a[1]} {b[1]}" for a, b in mixed])):
            got = {d.model.languages[x[2]] for x in found}
            right += len(got & {a[0], b[0]})
            wrong += len(got - {a[0], b[0]})
            total += 2
    print(f"mixed stretches: {right} of {total}, {wrong} wrong")
    assert right >= 0.9 * total and wrong <= 0.02 * total


def test_samples_are_drawn_from_every_language(spark):
    rows = [("a", f"text {i}") for i in range(500)] + [("b", f"other {i}") for i in range(40)] + [("c", "one"), (None, "x"), ("c", None)]
    got = g.drawn_samples(spark.createDataFrame(rows, "lang string, text string"), 90)
    assert {lang: sum(x == lang for x, _ in got) for lang in "abc"} == {"a": 30, "b": 30, "c": 1}
    with pytest.raises(FileNotFoundError, match="vocabulary"):
        g.read_pieces("/none")


def test_long_words_count_whole():
    hashes = g.read_pieces()
    long = g.Model.fit([("a", "é" * 25 + "qqqqzz"), ("b", "é" * 25 + "wwwwvv")], hashes, rounds=2)
    assert long.score(["é" * 25 + "qqqqzz"]).argmax() == 0 and long.score(["é" * 25 + "wwwwvv"]).argmax() == 1
