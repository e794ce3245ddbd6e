import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conceptloom.llm.leakage import Windows, leaks, tiles, words_of

small = st.lists(st.sampled_from("abcd"), max_size=40)


@given(small, small, st.integers(1, 4), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_tiles_match_and_do_not_overlap(a, b, least, first):
    found = tiles(a, b, least, first)
    used_a, used_b = set(), set()
    for i, j, k in found:
        assert k >= least and a[i : i + k] == b[j : j + k]
        assert not used_a & set(range(i, i + k)) and not used_b & set(range(j, j + k))
        used_a |= set(range(i, i + k))
        used_b |= set(range(j, j + k))
    longest = max((k for i in range(len(a)) for j in range(len(b)) for k in range(1, 41) if i + k <= len(a) and j + k <= len(b) and a[i : i + k] == b[j : j + k]), default=0)
    assert max((k for *_, k in found), default=0) == (longest if longest >= least else 0)


def test_windows_stay_in_their_text():
    owner, h = Windows(3).of(["a b c d", "x y", "", "A-b_c"])
    assert owner.tolist() == [0, 0, 3] and h[0] == h[2] != h[1]
    assert words_of("Don't STOP—at 3½ é_x") == ["don", "t", "stop", "at", "3½", "é", "x"]


@pytest.mark.parametrize("bits", [1 << 12, 1 << 25])
def test_against_brute_force(spark, bits):
    r = random.Random(0)
    word = lambda: f"w{r.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(30))) for i in range(30)]
    docs = []
    for d in range(300):
        text = [word() for _ in range(60)]
        if d % 3 == 0:  # a third of all documents holds the same passage
            text[20:20] = items[0][1].split()[5 : 5 + r.randrange(7, 14)]
        docs.append((1000 + d, "; ".join(text).upper()))
    shares = lambda a, b: any(b[j : j + 10] == a[i : i + 10] for i in range(len(a) - 9) for j in range(len(b) - 9))
    want = {(i, d) for i, a in items[:3] for d, b in docs if shares(words_of(a), words_of(b))}
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), filter_bits=bits)
    assert {(x.item_id, x.doc_id) for x in got.collect() if x.item_id < 3} == want and want


def test_reordered_passage_is_covered(spark):
    a = [f"w{i}" for i in range(30)]
    b = a[20:30] + ["x"] + a[0:7] + ["y"] + a[10:16]
    got = leaks(spark.createDataFrame([(2, " ".join(b))], "doc_id long, text string"), spark.createDataFrame([(1, " ".join(a))], "item_id long, text string")).first()
    assert (got.longest_run, got.n_tiles, got.covered_words) == (10, 3, 23)


def test_reordered_short_passages_come_out_by_coverage(spark):
    a = [f"w{i}" for i in range(40)]
    mixed = a[32:40] + ["x"] + a[0:8] + ["y"] + a[16:22] + ["z"] + a[24:30]
    few = a[:8] + ["x"] * 20
    docs = spark.createDataFrame([(2, " ".join(mixed)), (3, " ".join(few)), (4, " ".join(a[5:15]))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(a))], "item_id long, text string")
    got = {r.doc_id: (r.longest_run, r.covered_words) for r in leaks(docs, items, least_coverage=0.5).collect()}
    assert got == {2: (8, 28), 4: (10, 10)}
    assert [r.doc_id for r in leaks(docs, items).collect()] == [4]


def test_repetition_is_tiled_quickly():
    began = time.perf_counter()
    assert tiles(["x"] * 3000, ["x"] * 3000) == [(0, 0, 3000)]
    assert tiles(["x", "y"] * 800, ["y", "x"] * 900)[0][2] == 1600
    assert time.perf_counter() - began < 2


def test_edges(spark):
    ten = "eins zwei drei vier fünf sechs sieben acht neun zehn"
    docs = [(1, None, "clash"), (2, "", ""), (3, ten, ""), (4, "lang " * 200_000 + ten, ""), (5, ten[:-5], ""), (3, ten, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string, hits string")
    i = spark.createDataFrame([(1, ten, 0), (2, None, 0), (3, "", 0), (1, ten, 0)], "item_id long, text string, h int")
    assert {(r.item_id, r.doc_id) for r in leaks(d, i).collect()} == {(1, 3), (1, 4)}
    assert leaks(d.filter("false"), i).count() == 0 and leaks(d, i.filter("false")).count() == 0
