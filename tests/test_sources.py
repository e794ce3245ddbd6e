import json

from pyspark.sql import functions as F

from conceptloom.config import EngineConfig
from conceptloom.operators import graph
from conceptloom.sources import readers, sinks
from conceptloom.streaming import ingest


def test_json_lines_keep_what_is_malformed(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\nnot json\n{"b": 2}\n{"a": 3, "c": 4}\n')
    rows = readers.json_lines(spark, str(tmp_path / "a.jsonl"), "a long").cache()
    assert sorted(r.a for r in rows.filter("_corrupt is null").collect() if r.a) == [1, 3] and rows.filter("_corrupt is not null").count() == 1
    assert readers.json_document(spark, str(tmp_path / "none.json"), "a long").count() == 0


def test_text_units_count_blank_files(spark, tmp_path):
    for i, text in enumerate(["one", "  \n", "three"]):
        (tmp_path / f"{i}.TXT").write_text(text)
    got = readers.text_units(spark, str(tmp_path), "ch")
    assert sorted((r.unit_seq, r.raw_text) for r in got.collect()) == [(0, "one"), (2, "three")]
    again = {r.unit_id for r in readers.text_units(spark, str(tmp_path), "ch").collect()}
    assert again == {r.unit_id for r in got.collect()}


def test_numbers_follow_the_order(spark):
    rows = spark.createDataFrame([(f"p{i:04}",) for i in range(999, -1, -1)] + [(None,)], "path string").repartition(7)
    got = [(r.path, r.n) for r in readers.numbered(rows, "path").collect()]
    assert dict(got) == {None: 0} | {f"p{i:04}": i + 1 for i in range(1000)} and len(got) == 1001


def test_cues(spark, tmp_path):
    (tmp_path / "v.srt").write_text("1\r\n00:00:01,500 --> 00:00:02,000\r\nHello\r\nyou\r\n\r\n2\r\n01:00:00,000 --> 01:00:01,250\r\n \r\n\r\nWEBVTT\n\n00:05.000 --> 00:06.000\nEnd\n")
    got = [(r.span_start, r.span_end, r.raw_text) for r in readers.cue_units(spark, str(tmp_path / "v.srt"), "c").orderBy("unit_seq").collect()]
    assert got == [(1.5, 2.0, "Hello\nyou"), (5.0, 6.0, "End")]


def test_json_sources(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps({"items": [{"question": "q", "answer": "a", "wrong": ["x", "y"]}, {"question": "r", "answer": "b"}, {"question": "s"}]}))
    got = [r.raw_text for r in readers.question_units(spark, str(tmp_path / "q.json"), "c").orderBy("unit_seq").collect()]
    assert got == ["Q: q\nA: a\nWrong: x, y", "Q: r\nA: b\n"]
    (tmp_path / "t.json").write_text(json.dumps({"segments": [{"start": 1, "end": 2, "text": "hi"}]}))
    assert readers.transcript_units(spark, str(tmp_path / "t.json"), "c").first().span_end == 2.0
    (tmp_path / "u.json").write_text("{broken")
    broken = readers.unknown_json_units(spark, str(tmp_path / "u.json"), "c").first()
    assert (broken.raw_text, broken.span_end) == ("[]", 0.0)
    (tmp_path / "v.json").write_text('[{"a": 1}, 2, "x"]')
    (tmp_path / "w.json").write_text('{"a": [1, 2]}')
    assert [readers.unknown_json_units(spark, str(tmp_path / n), "c").first().span_end for n in ("v.json", "w.json")] == [3.0, 1.0]


def test_folder_listing_and_siblings(spark, tmp_path):
    for n in ("v.mp4", "v.vtt", "v.srt", "w.mp4", "p.pdf", "x.odd"):
        (tmp_path / n).write_text("x")
    listed = readers.files(spark, str(tmp_path))
    assert {r.name: r.kind for r in listed.collect()} == {"v.mp4": "video", "v.vtt": "text", "v.srt": "text", "w.mp4": "video", "p.pdf": "pdf", "x.odd": "skip"}
    got = {r.video.rsplit("/")[-1]: r.transcript and r.transcript.rsplit("/")[-1] for r in readers.sibling_transcripts(listed).collect()}
    assert got == {"v.mp4": "v.srt", "w.mp4": None}
    assert readers.media_units(listed, "video", "c").count() == 2


def test_page_chunks(spark):
    pages = spark.createDataFrame([("d", i, t) for i, t in enumerate(["a", "", "b", "c", None, "d"], 1)], "s string, p int, t string")
    got = [(r.first_page, r.last_page, r.chunk_text) for r in readers.page_chunks(pages, "s", "p", "t").orderBy("chunk").collect()]
    assert got == [(1, 4, "a\n\nb\n\nc"), (6, 6, "d")]


def test_sinks(spark, tmp_path):
    for value in ({"a": 1, "b": "old"}, {"a": "é"}):
        sinks.write_document(spark, str(tmp_path / "d.json"), value)
    assert [p.name for p in tmp_path.iterdir() if "tmp" in p.name] == []
    assert json.loads((tmp_path / "d.json").read_text()) == {"a": "é"}
    made = []
    make = lambda: made.append(1) or spark.range(3)
    for _ in range(2):
        assert sinks.materialised(spark, str(tmp_path / "t"), make).count() == 3
    assert made == [1] and sinks.stage_key(EngineConfig(), "a") != sinks.stage_key(EngineConfig(merge_similarity=0.5), "a")
    for key in ("k1", "k2", "k1"):
        sinks.materialised(spark, str(tmp_path / "keyed"), make, key)
    assert len(made) == 3
    for n in (2, 5):
        out = sinks.append_pending(spark.range(n), "id", str(tmp_path / "p"), lambda df: df.withColumn("x", F.lit(1)))
    assert out.count() == 5


def test_graph_files(spark, tmp_path):
    nodes = spark.createDataFrame([("a<", "Chapter", "x&"), ("b", "Source", None), ("c", "Source", "z")], "id string, type string, label string")
    edges = spark.createDataFrame([("a<", "b", "contains", 1.0)], "source string, target string, type string, confidence double")
    sinks.write_graphml(nodes, edges, str(tmp_path / "g"))
    import xml.dom.minidom

    text = "".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    assert len(xml.dom.minidom.parseString(text).getElementsByTagName("node")) == 3
    assert sinks.write_view(nodes, edges, str(tmp_path / "v.html"), "t") and not sinks.write_view(nodes.limit(2), edges, str(tmp_path / "w.html"), "t")
    page = (tmp_path / "v.html").read_text()
    assert '"source": "a<"' in page and "svg" in page
    many = spark.range(50).selectExpr("'a<' as source", "'b' as target", "'x' as type")
    assert not sinks.write_view(nodes, many, str(tmp_path / "x.html"), "t", most=2) and not sinks.write_view(nodes.limit(3), many, str(tmp_path / "x.html"), "t", most=3 - 1)
    assert graph.induced(nodes.filter("id <> 'b'"), edges).count() == 0


def test_streams(spark, sf, tmp_path):
    import shutil

    table = spark.read.parquet(f"{sf}/stage6_raw_relations.parquet")
    (tmp_path / "in").mkdir()
    for i in range(2):
        shutil.copy(f"{sf}/stage6_raw_relations.parquet", tmp_path / f"in/{i}.parquet")
    stream = ingest.arriving(spark, str(tmp_path / "in"), table)
    once = ingest.first_arrivals(stream, "relation_id", "ingested_at", "4000 days")
    ingest.append_to(once, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == table.select("relation_id").distinct().count()
    windows = ingest.arrivals_by_window(stream, "ingested_at", "30 days", "chapter_id", late="0 seconds")
    ingest.append_to(windows, str(tmp_path / "w"), str(tmp_path / "cw")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "w")).columns == ["since", "until", "chapter_id", "n"]
