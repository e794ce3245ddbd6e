import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conceptloom import adapters
from conceptloom.operators import extract, media, resolve, segments, topics
from conceptloom.sources import readers


def test_call_outs(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    with pytest.raises(adapters.NotConfigured):
        adapters.call_out(rows, None, "id int")

    def upper(batches):
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "reply": b["text"].str.upper()})

    replies = adapters.call_out(rows, upper, "id int, reply string")
    assert {r.id: r.reply for r in replies.collect()} == {1: "A", 2: "B"}
    assert [r.id for r in adapters.pending(rows, replies.filter("id = 1"), "id").collect()] == [2]
    assert {r.id: r.reply for r in adapters.recorded(rows, replies.filter("id = 1"), "id").collect()} == {1: "A", 2: None}
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id int")
    said = spark.createDataFrame([(1, " No, they differ"), (2, "<think>no\n</think> YES."), (3, "maybe")], "id int, reply string")
    assert {r.id: r.merge for r in adapters.decided(asked, said, "id").collect()} == {1: False, 2: True, 3: False, 4: False}


def test_hashed_embedding(spark):
    df = spark.createDataFrame([("a b",), ("B  a",), ("",), (None,), ("c d",)], "t string")
    e = [r.e for r in df.select(adapters.hashed_embedding(F.col("t"), 256).alias("e")).collect()]
    assert e[0] == e[1] != e[4] and abs(np.linalg.norm(e[0]) - 1) < 1e-6 and not any(e[2]) and e[2] == e[3]


def test_image_features():
    rng = np.random.default_rng(0)
    noise, flat = rng.integers(0, 256, (20, 20, 3)), np.full((20, 20, 3), 7)
    assert media.brightness_and_sharpness(flat) == pytest.approx((7.0, 0.0)) and media.brightness_and_sharpness(noise)[1] > 100
    assert media.brightness_and_sharpness(np.zeros((2, 2))) == (0.0, 0.0)
    h = media.colour_histogram(noise)
    assert h.shape == (32**3,) and h.sum() == pytest.approx(1) and media.correlation(h, h) == pytest.approx(1) and media.correlation(h, media.colour_histogram(flat)) < 0.5


def test_captions_and_sentences(spark):
    units = spark.createDataFrame([("u", "old"), ("v", "old"), ("w", None)], "unit_id string, visual_caption string")
    caps = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("v", 1, ""), ("v", 2, None)], "unit_id string, place int, caption string")
    assert {r.unit_id: r.visual_caption for r in segments.with_captions(units, caps).collect()} == {"u": "a\nb", "v": "old", "w": ""}
    units = spark.createDataFrame([("u", "video", "", ["k"]), ("v", "video", "", ["k"]), ("w", "pdf", "", ["k"]), ("x", "text", "", None)], "unit_id string, source_type string, visual_caption string, keyframe_paths array<string>")
    paths = spark.createDataFrame([("u", 2, "a,b"), ("w", 1, "c")], "unit_id string, n int, paths string")
    many = spark.createDataFrame([("u", i, f"c{i:02}") for i in range(50)], "unit_id string, place int, caption string")
    got = {r.unit_id: (r.visual_caption, r.keyframes) for r in segments.with_captions(units, many, paths).collect()}
    assert got == {"u": ("\n".join(f"c{i:02}" for i in range(50)), "a,b"), "v": ("", "k"), "w": ("", "k"), "x": ("", "")}
    df = spark.createDataFrame([(1, "One two. Three four! Five six seven"), (2, "a " * 50), (3, ""), (4, None)], "k int, t string")
    got = {r.k: r.chunk for r in segments.whole_sentences(df, "k", "t", 5).collect()}
    assert got == {1: "One two. Three four!", 2: ("a " * 50)[:30], 3: "", 4: None}


def test_topics_and_remap(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(0, 0.05, (10, 2)), rng.normal(3, 0.05, (10, 2)), [[50.0, 50.0]]])
    df = spark.createDataFrame([("a", i, p.tolist()) for i, p in enumerate(points)] + [("b", i, [float(i), 0.0]) for i in range(3)], "s string, i int, v array<double>")
    got = {(r.s, r.i): r.topic for r in topics.topic_clusters(df, "s", "i", "v", 4).collect()}
    assert got["a", 20] == got["a", 0] != got["a", 10] and {got["b", i] for i in range(3)} == {0}
    lines = spark.createDataFrame([(1, "\n T | s | a, ,b,c,d | 4/5\nU|v|1"), (2, "only")], "k int, t string")
    assert {r.k: (r.title, r.summary, r.top_concepts, r.difficulty) for r in extract.topic_lines(lines, "k", "t").collect()} == {1: ("T", "s", ["a", "b", "c"], 5), 2: ("only", "", [], 2)}
    assert {r.k: (r.title, r.summary, r.domains) for r in extract.chapter_lines(lines, "k", "t").collect()} == {1: ("T", "s", ["a", "b", "c", "d"]), 2: ("only", "", [])}
    ids = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    remap = spark.createDataFrame([("a", "z"), ("a", "y"), (None, "x")], "old_id string, canonical_id string")
    assert sorted(str(r.id) for r in resolve.remapped(ids, "id", remap).collect()) == ["None", "b", "y"]


def test_tables_and_paths(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "b"))
    assert readers.first_table(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 2
    with pytest.raises(FileNotFoundError):
        readers.first_table(spark, str(tmp_path / "a"))
    df = spark.createDataFrame([("/v/one.mp4", "/f/x.jpg")], "v string, f string")
    assert df.select(readers.selected_path("/out/", F.col("v"), F.col("f")).alias("p")).first().p == "/out/v/one/x.jpg"
