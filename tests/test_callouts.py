import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conceptloom import adapters
from conceptloom.operators import extract, frames, media
from conceptloom.sources import readers


def test_prompts(spark):
    df = spark.createDataFrame([("a", None), ("b", "c{d}")], "x string, y string")
    made = [r.p for r in df.select(adapters.prompt("On {x}: {y}!", x=F.col("x"), y=F.col("y")).alias("p")).collect()]
    assert made == ["On a: !", "On b: c{d}!"]
    with pytest.raises(KeyError):
        adapters.prompt("{z}")


def test_probe_speech_and_vectors_with_failures(spark, tmp_path):
    listed = spark.createDataFrame([("/a.mp4", "video"), ("/b.mp4", "video"), ("/c.png", "image")], "path string, kind string")

    def probe(batches):
        for b in batches:
            ok = b[b["path"] == "/a.mp4"]
            yield pd.DataFrame({"path": ok["path"], "duration": 12.5, "subtype": "lecture"})

    got = readers.media_units(listed, "video", "c", adapters.probed(listed.filter("kind = 'video'"), probe))
    assert {(r.source_path, r.video_subtype, r.span_end) for r in got.collect()} == {("/a.mp4", "lecture", 12.5), ("/b.mp4", "unknown", 0.0)}
    assert readers.media_units(listed, "image", "c").first().video_subtype == "null"
    texts = got.filter("source_path = '/a.mp4'").select("unit_id", F.lit("said").alias("text"))
    assert {(r.source_path, r.raw_text) for r in adapters.with_transcripts(got, texts).collect()} == {("/a.mp4", "said"), ("/b.mp4", "")}

    def see(batches):
        for b in batches:
            yield pd.DataFrame({"frame_path": b["frame_path"].iloc[:1], "embedding": [[1.0, 0.0]] * min(1, len(b))})

    seen = {r.frame_path: r.embedding for r in adapters.image_vectors(spark.createDataFrame([("f",), ("g",)], "frame_path string").coalesce(1), see, 2).collect()}
    assert sorted(map(tuple, seen.values())) == [(0.0, 0.0), (1.0, 0.0)]
    (tmp_path / "i.png").write_bytes(b"\x00\xff")
    assert readers.encoded_images(spark, str(tmp_path)).first().data == "AP8="


def test_scenes_are_kept_once(spark):
    rng = np.random.default_rng(2)
    base = [media.colour_histogram(rng.integers(0, 256, (12, 12, 3)), 4) for _ in range(6)]
    hists = [base[i % 6] + rng.normal(0, 1e-5 if i % 4 else 0.01, 64) for i in range(40)] + [np.full(64, 0.1)] * 2
    rows = [(f"f{i:02}", float(i // 2), h.tolist()) for i, h in enumerate(hists)] + [("none", 3.0, None)]
    kept: list[int] = []
    for i, h in enumerate(hists):
        if not any(media.correlation(h, hists[k]) >= 0.98 for k in kept):
            kept.append(i)
    got = frames.keep_first_scenes(spark.createDataFrame(rows, "frame_path string, timestamp_sec double, h array<double>"), "h")
    assert {r.frame_path for r in got.collect()} == {f"f{i:02}" for i in kept} | {"none"}


def test_single_clusters_take_the_densest(spark):
    df = spark.createDataFrame([("v", "a", 1.0, 5.0, "lab"), ("v", "b", 2.0, 9.0, "lab"), ("v", "c", 3.0, float("nan"), "lab"), ("w", "d", 1.0, None, "odd")], "video_path string, frame_path string, timestamp_sec double, text_density double, subtype string")
    sizes = frames.clusters_by_subtype(df, {"lab": 1}, 7)
    assert {r.video_path: r.k for r in sizes.collect()} == {"v": 1, "w": 1}
    assert {(r.video_path, r.frame_path) for r in frames.densest_of_single_clusters(df, sizes).collect()} == {("v", "b"), ("w", "d")}


def test_three_passes(spark):
    segs = spark.createDataFrame([("s1", "text", "optics"), ("s2", "text", None), ("q", "Q: a?\nA: b\nWrong: c", "")], "segment_id string, merged_text string, domain string")
    replies = [("s1", 1, "<think>x|fact|y</think>Lens|law|d"), ("s1", 2, "Lens|explains|Light|0.9"), ("s1", 3, "Lens|x|Light"), ("s2", 1, "nothing"), ("s2", 2, "A|explains|B"), ("q", 1, "no|fact|no")]
    concepts, relations = extract.extracted(segs, spark.createDataFrame(replies, "segment_id string, pass int, reply string"))
    assert {(r.segment_id, r.name) for r in concepts.collect()} == {("s1", "Lens"), ("q", "a?"), ("q", "c")}
    assert {(r.segment_id, r.relation, r.is_prereq) for r in relations.collect()} == {("s1", "explains", None), ("s1", "requires", True), ("q", "contrasts_with", False)}
    templates = {"concepts": "{domain}/{merged_text}", "relations": "{concept_list}/{context_short}", "prerequisites": "{concept_list}"}
    assert {r.segment_id: r.prompt for r in extract.pass_prompts(segs, templates).collect()}["s2"] == "general/text"
    found = spark.createDataFrame([("s1", 0, "Lens"), ("s1", 1, "Light")], "segment_id string, line_no int, name string")
    assert {(r.segment_id, r["pass"], r.prompt) for r in extract.pass_prompts(segs, templates, found, 2).collect()} == {("s1", 2, "- Lens\n- Light/te"), ("s1", 3, "- Lens\n- Light")}
