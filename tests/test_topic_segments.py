from conceptloom.operators import segments


def sequential(rows, vectors, cuts):
    """(session, part) as the units are walked in order."""
    out, session, since = [], 0, 0
    for i, (_, source, seconds) in enumerate(rows):
        new = i > 0 and (source != rows[i - 1][1] or seconds > 300 or i in cuts or sum(a * b for a, b in zip(vectors[i - 1], vectors[i])) < 0.5)
        session, since = (session + 1, 0) if new else (session, since + (i > 0))
        out.append((session, since // 8))
    return out


def test_all_four_boundaries(spark):
    rows = [(f"u{i:02}", "a" if i < 40 else "b", 10.0) for i in range(60)]
    rows[0], rows[5] = ("u00", "a", 400.0), ("u05", "a", 301.0)
    axis = [0.8, 0.6]  # unlike neither before nor after
    vectors = [[1.0, 0.0] if i < 20 else axis if i < 50 else [-1.0, 0.0] for i in range(60)]
    units = spark.createDataFrame(
        [(u, "k", i, s, "text", 0.0, t, "w", "", "", []) for i, (u, s, t) in enumerate(rows)],
        "unit_id string, chapter_id string, unit_seq long, source_path string, source_type string, span_start double, span_end double, raw_text string, visual_caption string, ocr_text string, keyframe_paths array<string>",
    )
    given = spark.createDataFrame([(u, v) for (u, _, _), v in zip(rows, vectors)], "unit_id string, embedding array<double>")
    got = [(x.session, x.part) for x in segments.topic_segments(units, vectors=given).orderBy("unit_seq").collect()]
    assert got == sequential(rows, vectors, {20, 50})
    assert got[0] == (0, 0) and got[5][0] == 1 and got[40][0] > got[39][0] and got[50][0] > got[49][0]
    bare = [(x.session, x.part) for x in segments.topic_segments(units).orderBy("unit_seq").collect()]
    assert bare == sequential(rows, [[1.0]] * 60, {})
    assert segments.segment_rollup(units, by=segments.topic_segments).count() == len(set(bare))
