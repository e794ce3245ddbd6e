from hypothesis import given, settings
from hypothesis import strategies as st

from conceptloom.llm.splitting import split_items, split_texts


def checked(text, limit=200, overlap=20):
    pieces = list(split_texts([text], limit, overlap))
    assert "".join(text[a + o : e] for _, _, a, e, o, _ in pieces) == text
    for k, (_, p, a, e, o, _) in enumerate(pieces):
        assert p == k + 1 and 0 < e - a <= limit and (o == 0 if k == 0 else 0 < o <= overlap + 8)
    return pieces


words = st.text(st.sampled_from("ab .,\n。，हि́"), min_size=201, max_size=2000)


@given(words)
@settings(max_examples=150, deadline=None)
def test_round_trip(text):
    checked(text)


def greedy(text, limit, overlap):
    """The same cuts found one after another."""
    from conceptloom.llm.splitting import _Table

    t = _Table([text], limit, overlap)
    at, out = 0, [0]
    while t.following[at] != at:
        at = int(t.following[at])
        out.append(int(t.at[at]))
    return out


@given(words)
@settings(max_examples=50, deadline=None)
def test_doubling_finds_the_greedy_cuts(text):
    assert [0, *(p[3] for p in checked(text))] == greedy(text, 200, 20)


def test_cuts_at_stops_else_clauses_else_spaces_else_anywhere():
    sentence = "Some words of a sentence here. "
    assert all(text[-1] == "." for text in ((sentence * 30)[a:e] for _, _, a, e, _, k in checked(sentence * 30)[:-1]))
    assert {p[5] for p in checked("word, " * 100)[:-1]} == {"clause"}
    assert {p[5] for p in checked("word " * 100)[:-1]} == {"space"}
    assert {p[5] for p in checked("x" * 1000)[:-1]} == {"hard"}
    assert {p[5] for p in checked("中文句子。" * 100)[:-1]} == {"stop"}
    # hard cuts lie at the limit
    assert [p[3] for p in checked("x" * 1000)] == [200, 380, 560, 740, 920, 1000]
    # a stop far back gives way to a later pause, but not to a hard cut
    assert checked("One. " + "word " * 100)[0][3] == 199 and checked("One. " + "x" * 1000)[0][3] == 4


@given(words)
@settings(max_examples=80, deadline=None)
def test_pieces_are_half_full_where_a_pause_allows_it(text):
    from conceptloom.llm.splitting import _CLAUSE, _STOP, _WORD_END, _ends

    pauses = sorted({int(x) for p in (_STOP, _CLAUSE, _WORD_END) for x in _ends(p, text)} - {0})
    pieces = checked(text)
    for _, _, a, e, _, kind in pieces[:-1]:
        full = [x for x in pauses if a + 100 <= x <= a + 200]
        assert e - a >= 100 or not full
        assert kind != "hard" or not [x for x in pauses if a + pieces[0][4] < x <= a + 200 and x > a + 20]


def test_many_texts_at_once_are_independent():
    texts = ["a b. " * 100, "x" * 700, "word " * 90]
    both = list(split_texts(texts, 200, 20))
    for i, t in enumerate(texts):
        assert [p[1:] for p in both if p[0] == i] == [p[1:] for p in split_texts([t], 200, 20)]


def test_rows(spark):
    rows = [("t", "null", None), ("t", "empty", ""), ("t", "fits", "a" * 2000), ("t", "over", " " * 2001), ("t", "long", "Satz. " * 50_000), ("t", "emoji", "😀" * 2001), (None, None, "b " * 1500), ("t", "over", " " * 2001)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "item_table string, item_id string, text string, piece int, cut string")
    got = split_items(df).collect()
    assert {r.item_id for r in got} == {"over", "long", "emoji", None}
    longest = sorted((r for r in got if r.item_id == "long"), key=lambda r: r.piece)
    assert "".join(r.piece_text[r.overlap :] for r in longest) == "Satz. " * 50_000 and max(len(r.piece_text) for r in got) <= 2000
    assert split_items(df.filter("false")).count() == 0
