"""SQL (DuckDB) for the queries of pipeline.py, over whole tables."""

from __future__ import annotations

from conceptloom.config import CONCEPT_TYPES, DOMAINS, EXTENSIONS, NODE_TYPES, RELATIONS
from conceptloom.operators.graph import BORDERS, CUTS, DOMAIN_COLORS, EDGE_COLORS, NO_DOMAIN, NO_EDGE, SIZES, SUMMARY_EDGES

WHITE = r"[\s\x0B\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LINE_END = r"\r\n|[\n\r\x0B\f\x1c-\x1e\x{0085}\x{2028}\x{2029}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WHITE}+|{WHITE}+$', '', 'g')"


def name(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '[ \\t\\x{{00A0}}]+', ' ', 'g')))"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WHITE}+'), lambda x: x <> '')"


def quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


UNITS = "units AS (SELECT DISTINCT ON (unit_id) * FROM stage3_transcripts)"
SEGS = "segs AS (SELECT DISTINCT ON (segment_id) * FROM stage5_segments)"
FRAMES = "frames AS (SELECT DISTINCT ON (frame_path) * FROM stage2_selected_frames)"
RAW = f"raw AS (SELECT DISTINCT ON (concept_id) *, {name('name')} AS form FROM stage6_raw_concepts)"
RELS = f"rels AS (SELECT DISTINCT ON (relation_id) *, {name('source_name')} AS sk, {name('target_name')} AS tk FROM stage6_raw_relations)"
CANON = "canon AS (SELECT DISTINCT ON (concept_id) * FROM stage7_canonical_concepts)"
CONTEXT = strip("concat_ws(' ', nullif(raw_text, ''), nullif(visual_caption, ''), nullif(ocr_text, ''))")



def embedded(rows: str, key: str, text: str, name: str) -> str:
    """Places of the default embedder's vectors that aren't 0: (key, place, v), from the words' MD5."""
    return f"""
{name}_words AS (SELECT {key}, unnest({words(f"lower({text})")}) AS w FROM {rows}),
{name}_hashes AS (SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) AS h FROM {name}_words),
{name}_sums AS (SELECT {key}, h % 64 AS place, CAST(sum(CASE WHEN h >= 2147483648 THEN 1 ELSE -1 END) AS DOUBLE) AS v FROM {name}_hashes GROUP BY ALL HAVING sum(CASE WHEN h >= 2147483648 THEN 1 ELSE -1 END) <> 0),
{name} AS (SELECT {key}, place, v / sqrt(sum(v * v) OVER (PARTITION BY {key})) AS v FROM {name}_sums)"""


# A unit opens a segment if its source is another than the one before, its vector unlike, or its span longer than 300 s.
_SESSIONS = f"""
WITH {UNITS}, texts AS (SELECT unit_id, coalesce(nullif({CONTEXT}, ''), 'no content') AS context FROM units), {embedded("texts", "unit_id", "context", "vectors")},
placed AS (SELECT *, lag(unit_id) OVER w AS before, lag(source_path) OVER w AS source_before FROM units WINDOW w AS (PARTITION BY chapter_id ORDER BY unit_seq, unit_id)),
likeness AS (SELECT p.unit_id, sum(a.v * b.v) AS s FROM placed p JOIN vectors a ON a.unit_id = p.unit_id JOIN vectors b ON b.unit_id = p.before AND b.place = a.place GROUP BY 1),
flagged AS (
  SELECT p.*, before IS NOT NULL AND source_before IS DISTINCT FROM source_path AS new_source,
    before IS NOT NULL AND (source_before IS DISTINCT FROM source_path OR round(coalesce(s, 0), 6) < 0.5 OR coalesce(span_end - span_start > 300, false)) AS boundary
  FROM placed p LEFT JOIN likeness USING (unit_id)
), counted AS (
  SELECT *, CAST(sum(boundary::INT) OVER (PARTITION BY chapter_id ORDER BY unit_seq, unit_id) AS BIGINT) AS session FROM flagged
), parts AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY chapter_id, session ORDER BY unit_seq, unit_id) - 1) // 8 AS BIGINT) AS part FROM counted
)
"""
_INDEX = f"""
idx AS (
  SELECT chapter_id, key, first(concept_id ORDER BY concept_seq, place, concept_id) AS first_id, last(concept_id ORDER BY concept_seq, place, concept_id) AS last_id
  FROM (
    SELECT chapter_id, concept_id, concept_seq, place, {name("n")} AS key FROM (
      SELECT chapter_id, concept_id, concept_seq, unnest(list_concat([name], coalesce(aliases, []))) AS n, generate_subscripts(list_concat([name], coalesce(aliases, [])), 1) AS place FROM canon
    )
  ) WHERE key <> '' GROUP BY 1, 2
)
"""
_RESOLVED = """
resolved AS (
  SELECT r.*, s.first_id AS s1, t.first_id AS t1, s.last_id AS s2, t.last_id AS t2 FROM rels r
  JOIN idx s ON s.chapter_id = r.chapter_id AND s.key = r.sk JOIN idx t ON t.chapter_id = r.chapter_id AND t.key = r.tk
)
"""
_SURE = "coalesce(CASE WHEN isnan(confidence) THEN NULL ELSE confidence END, 0.0)"
_PREREQ = "(coalesce(is_prereq, false) OR coalesce(relation = 'requires', false))"
_EDGES = f"""
edges AS (
  SELECT chapter_id, s1 AS source, t1 AS target, greatest(0.0, max({_SURE})) AS confidence FROM resolved WHERE {_PREREQ} AND s1 <> t1 GROUP BY 1, 2, 3
)
"""
_PREREQS = f"WITH RECURSIVE {RELS}, {CANON}, {_INDEX}, {_RESOLVED}, {_EDGES}"
# The longest path to a node; nodes on or behind cycles are left out: they are what a cycle reaches.
_DEPTHS = (
    _PREREQS
    + """, reach AS (
  SELECT chapter_id, source AS a, target AS b FROM edges UNION SELECT r.chapter_id, r.a, e.target FROM reach r JOIN edges e ON e.chapter_id = r.chapter_id AND e.source = r.b
), bad AS (
  SELECT chapter_id, a AS node FROM reach WHERE a = b UNION SELECT r.chapter_id, r.b FROM reach r JOIN reach c ON c.chapter_id = r.chapter_id AND c.a = c.b AND c.a = r.a
), good AS (
  SELECT * FROM edges e WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.chapter_id = e.chapter_id AND b.node = e.target)
), nodes AS (
  SELECT chapter_id, source AS node FROM edges UNION SELECT chapter_id, target FROM edges
), walk AS (
  SELECT chapter_id, node, CAST(0 AS BIGINT) AS depth FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.chapter_id = n.chapter_id AND b.node = n.node)
  UNION SELECT w.chapter_id, g.target, w.depth + 1 FROM walk w JOIN good g ON g.chapter_id = w.chapter_id AND g.source = w.node
), depths AS (SELECT chapter_id, node, max(depth) AS depth FROM walk GROUP BY 1, 2)
"""
)


def _canonical(group: str) -> str:
    """Canonical concepts of the groups that a column of raw, or of what it is joined with, names."""
    return f"""
f AS (SELECT *, {group} AS grp, coalesce(frequency, 1) AS f FROM raw), most AS (SELECT chapter_id, max(f) AS most FROM f GROUP BY 1),
scored AS (SELECT f.*, most, 0.7 * {_SURE} + 0.3 * f / greatest(most, 1) AS score FROM f JOIN most USING (chapter_id)),
best AS (
  SELECT chapter_id, grp, concept_id AS canonical_id, name, type, domain, definition, confidence AS c FROM scored
  QUALIFY row_number() OVER (PARTITION BY chapter_id, grp ORDER BY score DESC, concept_seq) = 1
), sums AS (SELECT chapter_id, grp, CAST(sum(f) AS BIGINT) AS frequency, max(most) AS most FROM scored GROUP BY 1, 2),
names AS (SELECT chapter_id, grp, list(name ORDER BY q) AS names FROM (SELECT chapter_id, grp, name, min(concept_seq) AS q FROM f WHERE name <> '' GROUP BY 1, 2, 3) GROUP BY 1, 2),
segments AS (SELECT chapter_id, grp, list(segment_id ORDER BY q) AS segments FROM (SELECT chapter_id, grp, segment_id, min(concept_seq) AS q FROM f WHERE segment_id <> '' GROUP BY 1, 2, 3) GROUP BY 1, 2),
canonical AS (
  SELECT b.*, frequency, most, list_filter(coalesce(names, []), lambda x: x IS DISTINCT FROM b.name) AS aliases, coalesce(segments, []) AS segments
  FROM best b JOIN sums s ON s.chapter_id = b.chapter_id AND s.grp IS NOT DISTINCT FROM b.grp
  LEFT JOIN names n ON n.chapter_id = b.chapter_id AND n.grp IS NOT DISTINCT FROM b.grp LEFT JOIN segments g ON g.chapter_id = b.chapter_id AND g.grp IS NOT DISTINCT FROM b.grp
)
"""


def _shown(group: str) -> str:
    return f"""SELECT chapter_id, grp AS {group}, canonical_id, name, type, domain, md5(definition) AS definition_md5, frequency, round(least(1.0, 0.7 * {_SURE.replace("confidence", "c")} + 0.3 * frequency / greatest(most, 1)), 6) AS confidence,
  CAST(len(aliases) AS BIGINT) AS n_aliases, md5(array_to_string(aliases, '|')) AS aliases_md5, CAST(len(segments) AS BIGINT) AS n_segments, md5(array_to_string(segments, '|')) AS segments_md5 FROM canonical"""


_REMAP = "SELECT f.concept_id AS old_id, c.canonical_id FROM f JOIN canonical c ON c.chapter_id = f.chapter_id AND c.grp IS NOT DISTINCT FROM f.grp WHERE f.concept_id <> c.canonical_id"
_CANONICAL = f"WITH {RAW}, {_canonical('form')}"


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: rows of the table, each from the one before as maxima from the left."""
    return f"""list_last(list_reduce(list_prepend(list_transform(range(0, length({b}) + 1), lambda x: CAST(0 AS BIGINT)), list_transform(string_split({a}, ''), lambda c: [CAST(ord(c) AS BIGINT)])),
    lambda r, c: list_prepend(CAST(0 AS BIGINT), list_transform(range(1, length({b}) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(r[k + 1], r[k] + CASE WHEN ord({b}[k]) = c[1] THEN 1 ELSE 0 END)))))))"""


def _similar(items: str) -> str:
    """pairs of items (chapter_id, norm, seq) whose indel ratio is at least 90."""
    near = "floor(0.1 * (length(a.norm) + length(b.norm)) + 1e-9)"
    return f"""
near AS (
  SELECT a.chapter_id, a.seq AS seq_a, b.seq AS seq_b, a.norm AS x, b.norm AS y FROM {items} a JOIN {items} b ON a.chapter_id = b.chapter_id AND a.seq < b.seq
    AND abs(length(a.norm) - length(b.norm)) <= {near} AND (strlen(a.norm) <> length(a.norm) OR strlen(b.norm) <> length(b.norm) OR levenshtein(a.norm, b.norm) <= {near})
), pairs AS MATERIALIZED (
  SELECT * FROM (SELECT chapter_id, seq_a, seq_b, CASE WHEN x = '' OR y = '' THEN CASE WHEN x = y THEN 100.0 ELSE 0 END ELSE 200.0 * {_lcs("x", "y")} / (length(x) + length(y)) END AS ratio FROM near) WHERE ratio >= 90
)"""


# Leaders one after another: an item joins its first similar leader or leads.
_WALK = """
linked AS MATERIALIZED (SELECT scope, seq_a AS seq FROM pairs UNION SELECT scope, seq_b FROM pairs),
prior AS MATERIALIZED (
  SELECT i.scope, i.seq, row_number() OVER (PARTITION BY i.scope ORDER BY i.seq) AS k, p.near FROM linked i LEFT JOIN (SELECT scope, seq_b, list(seq_a) AS near FROM pairs GROUP BY 1, 2) p ON p.scope = i.scope AND p.seq_b = i.seq
), steps AS (
  SELECT DISTINCT scope, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS heads, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS leader FROM linked
  UNION ALL
  SELECT scope, k, CASE WHEN hit IS NULL THEN list_append(heads, seq) ELSE heads END, seq, coalesce(hit, seq) FROM (
    SELECT w.scope, p.k, w.heads, CAST(p.seq AS BIGINT) AS seq, CAST(list_min(list_filter(coalesce(p.near, []), lambda x: list_contains(w.heads, x))) AS BIGINT) AS hit FROM steps w JOIN prior p ON p.scope = w.scope AND p.k = w.k + 1
  )
), walk AS (SELECT i.scope, i.seq, coalesce(s.leader, i.seq) AS leader FROM items i LEFT JOIN steps s ON s.scope = i.scope AND s.seq = i.seq)"""
_LEXICAL = f"""
WITH RECURSIVE raw AS (SELECT DISTINCT ON (concept_id) *, regexp_replace(lower({strip("name")}), '[^\\p{{L}}\\p{{M}}\\p{{N}} ]', '', 'g') AS norm FROM stage6_raw_concepts),
named AS (SELECT chapter_id, norm, min(concept_seq) AS seq FROM raw GROUP BY 1, 2), {_similar("named").replace("pairs AS MATERIALIZED", "ratios AS MATERIALIZED")},
items AS (SELECT chapter_id AS scope, seq FROM named), pairs AS (SELECT chapter_id AS scope, seq_a, seq_b FROM ratios), {_WALK},
lexical AS (SELECT r.concept_id, w.leader FROM raw r JOIN named n ON n.chapter_id = r.chapter_id AND n.norm = r.norm JOIN walk w ON w.scope = n.chapter_id AND w.seq = n.seq)
"""
_FUZZY = _LEXICAL.replace("WITH RECURSIVE raw AS", "WITH RECURSIVE raw0 AS").replace("FROM raw GROUP", "FROM raw0 GROUP").replace("FROM raw r", "FROM raw0 r") + f", raw AS (SELECT raw0.*, leader FROM raw0 JOIN lexical USING (concept_id)), {_canonical('leader')}"


def _graph_of(canon: str) -> str:
    """Nodes and links of a table of canonical concepts."""
    return f"""
WITH RECURSIVE {RELS}, canon AS ({canon}), {_INDEX}, {_RESOLVED}, {_EDGES},
reach AS (SELECT chapter_id, source AS a, target AS b FROM edges UNION SELECT r.chapter_id, r.a, e.target FROM reach r JOIN edges e ON e.chapter_id = r.chapter_id AND e.source = r.b),
atomic AS (
  SELECT concept_id AS id, 'AtomicConcept' AS type, name AS label, coalesce(nullif(domain, ''), 'general') AS domain, chapter_id,
    CAST(coalesce(frequency, 1) AS BIGINT) AS frequency, CAST(coalesce(len(source_segments), 0) AS BIGINT) AS n_evidence, type AS concept_type, definition, confidence, aliases, source_segments AS evidence FROM canon
), topics AS (
  SELECT concat_ws('/', chapter_id, domain) AS id, 'TopicGodNode' AS type, domain AS label, domain, chapter_id, count(*) AS frequency, CAST(0 AS BIGINT) AS n_evidence FROM atomic GROUP BY chapter_id, domain
), nodes AS (
  SELECT * FROM atomic UNION ALL SELECT *, NULL, NULL, NULL, NULL, NULL FROM topics
  UNION ALL SELECT 'chapter:' || chapter_id, 'Chapter', chapter_id, NULL, chapter_id, count(*), 0, NULL, NULL, NULL, NULL, NULL FROM atomic GROUP BY chapter_id
  UNION ALL SELECT sha256('source:' || source_path), 'Source', regexp_extract(source_path, '([^/]*)$', 1), NULL, min(chapter_id), count(DISTINCT unit_id), 0, NULL, NULL, NULL, NULL, NULL FROM stage3_transcripts WHERE source_path <> '' GROUP BY source_path
), bare AS (
  SELECT 'chapter:' || chapter_id AS source, id AS target, 'has_topic' AS type, 1.0 AS confidence, chapter_id FROM topics
  UNION ALL SELECT concat_ws('/', chapter_id, domain), id, 'contains', 1.0, chapter_id FROM atomic
  UNION ALL SELECT source, target, 'requires', confidence, chapter_id FROM edges
  UNION ALL SELECT s2, t2, relation, max({_SURE}), chapter_id FROM resolved WHERE NOT {_PREREQ} AND s2 <> t2 AND relation IN ({quoted(RELATIONS)}) GROUP BY s2, t2, relation, chapter_id
), paths AS (SELECT DISTINCT segment_id, unnest(source_paths) AS path FROM stage5_segments), links AS (
  SELECT b.source, b.target, b.type, b.confidence, coalesce(s.domain <> '' AND t.domain <> '' AND s.domain <> t.domain, false) AS cross_domain, b.chapter_id
  FROM bare b LEFT JOIN atomic s ON s.id = b.source LEFT JOIN atomic t ON t.id = b.target
  UNION ALL SELECT DISTINCT c.id, sha256('source:' || path), 'appears_in', 1.0, false, c.chapter_id FROM (SELECT id, chapter_id, unnest(evidence) AS segment_id FROM atomic) c JOIN paths USING (segment_id)
  WHERE path IN (SELECT source_path FROM stage3_transcripts WHERE source_path <> '')
)
"""


_GRAPH = _graph_of("SELECT DISTINCT ON (concept_id) * FROM stage7_canonical_concepts WHERE deleted_at IS NULL")
_RAW_GRAPH = _graph_of("SELECT DISTINCT ON (concept_id) *, CAST([] AS VARCHAR[]) AS aliases, [segment_id] AS source_segments FROM stage6_raw_concepts")
# Depths of live concepts: longest paths to the nodes that no cycle reaches, 0 for the rest.
_LEVELS = """, walked AS (
  SELECT chapter_id, node, max(depth) AS depth FROM (
    WITH RECURSIVE bad AS (SELECT chapter_id, a AS node FROM reach WHERE a = b UNION SELECT r.chapter_id, r.b FROM reach r JOIN reach c ON c.chapter_id = r.chapter_id AND c.a = c.b AND c.a = r.a),
    good AS (SELECT * FROM edges e WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.chapter_id = e.chapter_id AND b.node = e.target)),
    walk AS (
      SELECT chapter_id, node, CAST(0 AS BIGINT) AS depth FROM (SELECT chapter_id, source AS node FROM edges UNION SELECT chapter_id, target FROM edges) n WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.chapter_id = n.chapter_id AND b.node = n.node)
      UNION SELECT w.chapter_id, g.target, w.depth + 1 FROM walk w JOIN good g ON g.chapter_id = w.chapter_id AND g.source = w.node
    ) SELECT * FROM walk) GROUP BY 1, 2
), levels AS (SELECT id, coalesce(depth, 0) AS level FROM atomic LEFT JOIN walked ON node = id),
topic_levels AS (SELECT concat_ws('/', chapter_id, domain) AS id, CAST(greatest(1, least(5, CAST(trunc(avg(level)) AS BIGINT) + 1)) AS BIGINT) AS level FROM atomic JOIN levels USING (id) GROUP BY chapter_id, domain)
"""
_BY = lambda column, table, other: f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in table.items()) + f" ELSE {other!r} END"


def _induced(nodes: str, edges: str = "true", columns: str = "source, target, type") -> str:
    return _GRAPH + f"SELECT {columns} FROM links WHERE {edges} AND source IN (SELECT id FROM nodes WHERE {nodes}) AND target IN (SELECT id FROM nodes WHERE {nodes})"


def _lines(table: str, key: str, where: str = "true") -> str:
    return f"""
lines AS (
  SELECT {key}, line_no, {strip("line")} AS line FROM (
    SELECT {key}, unnest(regexp_split_to_array(raw_line, '{LINE_END}')) AS line, generate_subscripts(regexp_split_to_array(raw_line, '{LINE_END}'), 1) AS line_no
    FROM (SELECT DISTINCT ON ({key}) * FROM {table} WHERE {where})
  )
), cut AS (
  SELECT {key}, line_no, list_transform(string_split(line, '|'), lambda x: {strip("x")}) AS p FROM lines WHERE line <> '' AND line NOT LIKE '#%'
)"""



def _reply(k: str, table: str, key: str, seq: str, where: str = "true") -> str:
    """Lines of the replies of one pass, cut at pipes, of segments that aren't questions."""
    return f"""said{k} AS (
  SELECT segment_id, string_agg(raw_line, chr(10) ORDER BY {seq}) AS t FROM (SELECT DISTINCT ON ({key}) * FROM {table}) WHERE raw_line IS NOT NULL AND {where} AND segment_id IN (SELECT segment_id FROM segs WHERE NOT asks) GROUP BY 1
), lines{k} AS (
  SELECT segment_id, line_no, {strip("line")} AS line FROM (SELECT segment_id, unnest(regexp_split_to_array(t, '{LINE_END}')) AS line, generate_subscripts(regexp_split_to_array(t, '{LINE_END}'), 1) AS line_no FROM said{k})
), cut{k} AS (SELECT segment_id, line_no, list_transform(string_split(line, '|'), lambda x: {strip("x")}) AS p FROM lines{k} WHERE line <> '' AND line NOT LIKE '#%')"""


_SUFFIX = "lower(regexp_extract(regexp_extract(source_path, '([^/]*)$', 1), '.(\\.[^.]+)$', 1))"
_KIND = "CASE " + " ".join(f"WHEN {_SUFFIX} IN ({quoted(v)}) THEN '{k}'" for k, v in EXTENSIONS.items()) + " ELSE 'skip' END"
_DENSITY = "coalesce(CASE WHEN isnan(text_density) THEN NULL ELSE text_density END, -1.0)"
_Q = lambda mark: strip(f"substr(max_by(line, line_no) FILTER (line LIKE '{mark}%'), {len(mark) + 1})")
_EXTRACTED = f"""segs AS (SELECT DISTINCT ON (segment_id) *, coalesce({strip("merged_text")} LIKE 'Q:%' AND merged_text LIKE '%A:%', false) AS asks FROM stage5_segments),
{_reply("1", "stage6_raw_concepts", "concept_id", "concept_seq")}, {_reply("2", "stage6_raw_relations", "relation_id", "relation_seq", "relation <> 'requires'")}, {_reply("3", "stage6_raw_relations", "relation_id", "relation_seq", "relation = 'requires'")},
pass1 AS (SELECT * FROM cut1 WHERE len(p) >= 3 AND length(p[1]) BETWEEN 1 AND 120 QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY line_no) <= 20),
asked AS (SELECT segment_id, line_no, {strip("line")} AS line FROM (
  SELECT segment_id, unnest(regexp_split_to_array(merged_text, '{LINE_END}')) AS line, generate_subscripts(regexp_split_to_array(merged_text, '{LINE_END}'), 1) AS line_no FROM segs WHERE asks)),
qa AS (SELECT * FROM (SELECT segment_id, {_Q("Q:")} AS q, {_Q("A:")} AS a, substr(max_by(line, line_no) FILTER (line LIKE 'Wrong:%'), 7) AS ws FROM asked GROUP BY 1) WHERE q <> '' AND a <> ''),
wrong AS (SELECT segment_id, q, unnest(list_filter(list_transform(string_split(ws, ','), lambda x: {strip("x")}), lambda x: x <> '')) AS w FROM qa)"""
_NAMED = f"list_filter(list_transform(string_split(coalesce(p[3], ''), ','), lambda x: {strip('x')}), lambda x: x <> '')"
_DOT = "list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"

SQL = {
    "route_by_type": f"SELECT {_KIND} AS kind, source_type, count(*) AS n FROM stage3_transcripts GROUP BY 1, 2",
    "text_units_ordinal": """SELECT doc_id, ordinal - 1 AS ordinal, md5(line) AS line_md5 FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ordinal FROM documents) WHERE trim(line, ' ') <> ''""",
    "page_chunks_of_3": f"""WITH {UNITS}, pages AS (
  SELECT *, (row_number() OVER (PARTITION BY source_path ORDER BY unit_seq) - 1) // 3 AS chunk FROM units WHERE source_type = 'pdf' AND {strip("raw_text")} <> ''
) SELECT source_path, chunk, min(unit_seq) AS first_page, max(unit_seq) AS last_page, md5(string_agg(raw_text, chr(10) || chr(10) ORDER BY unit_seq)) AS chunk_md5 FROM pages GROUP BY 1, 2""",
    "qa_units": "SELECT item_id, 'Q: ' || text || chr(10) || 'A: ' || answer || chr(10) || CASE WHEN exam <> '' THEN 'Wrong: ' || exam ELSE '' END AS unit_text FROM eval_items",
    "merge_context": f"SELECT DISTINCT unit_id, md5({CONTEXT}) AS context_md5 FROM stage3_transcripts",
    "chunk_words": f"SELECT doc_id, md5(array_to_string(({words('text')})[1:64], ' ')) AS head_md5 FROM documents",
    "sentence_chunks": f"""WITH p AS (
  SELECT doc_id, text, unnest(regexp_extract_all(text, '[^.!?]*[.!?]+\\s*|[^.!?]+$')) AS s, generate_subscripts(regexp_extract_all(text, '[^.!?]*[.!?]+\\s*|[^.!?]+$'), 1) AS i FROM documents
), n AS (SELECT *, sum(len({words("s")})) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM p), c AS (SELECT doc_id, string_agg(s, '' ORDER BY i) AS t FROM n WHERE n <= 40 GROUP BY 1)
SELECT doc_id, md5(coalesce({strip("t")}, substr(text, 1, 240))) AS chunk_md5 FROM documents LEFT JOIN c USING (doc_id)""",
    "caption_join": f"""WITH {UNITS}, {FRAMES}, r AS (
  SELECT unit_id, 'frame ' || regexp_extract(frame_path, '([^/]*)$', 1) AS c, row_number() OVER (PARTITION BY unit_id ORDER BY frame_num NULLS FIRST, 'frame ' || regexp_extract(frame_path, '([^/]*)$', 1)) AS r FROM frames
), j AS (SELECT unit_id, string_agg(c, chr(10) ORDER BY r) AS new FROM r GROUP BY 1),
k AS (SELECT unit_id, string_agg(coalesce(nullif(selected_frame_path, ''), frame_path), ',' ORDER BY timestamp_sec NULLS LAST, frame_path) AS paths FROM frames WHERE coalesce(unit_id, '') <> '' GROUP BY 1)
SELECT unit_id, md5(coalesce(new, visual_caption, '')) AS caption_md5, md5(coalesce(CASE WHEN source_type = 'video' THEN paths END, array_to_string(keyframe_paths, ','), '')) AS keyframes_md5
FROM units LEFT JOIN j USING (unit_id) LEFT JOIN k USING (unit_id)""",
    "frame_units": f"""WITH {UNITS}, {FRAMES}, first_units AS (SELECT source_path, first(unit_id ORDER BY unit_seq, unit_id) AS u FROM units WHERE source_type = 'video' GROUP BY 1)
SELECT frame_path, coalesce(u, '') AS unit_id FROM frames LEFT JOIN first_units ON source_path = video_path""",
    "modality_coverage": "SELECT chapter_id, count(DISTINCT source_type) AS n_types, count(DISTINCT source_path) AS n_sources, count(DISTINCT unit_id) AS n_units FROM stage3_transcripts GROUP BY 1",
    "transcript_overlap": f"""WITH {UNITS}, {SEGS}, spans AS (SELECT segment_id, span_start, span_end, unnest(list_distinct(source_paths)) AS p FROM segs)
SELECT s.segment_id, count(*) AS n_cues, min(u.unit_id) AS first_id FROM spans s JOIN units u ON u.source_path = s.p AND u.source_type = 'video'
  AND ((s.span_start = 0 AND s.span_end = 0) OR (u.span_end >= s.span_start AND u.span_start <= s.span_end)) GROUP BY 1""",
    "point_in_interval": f"""WITH {SEGS}, {FRAMES}, ids AS (SELECT segment_id, span_start, span_end, unnest(list_distinct(unit_ids)) AS u FROM segs), met AS (
  SELECT segment_id, frame_path, row_number() OVER (PARTITION BY segment_id ORDER BY timestamp_sec, frame_path) AS r FROM ids JOIN frames ON unit_id = u AND timestamp_sec BETWEEN span_start AND span_end
) SELECT segment_id, count(*) AS n_frames, string_agg(frame_path, ',' ORDER BY r) FILTER (r <= 10) AS keyframes FROM met GROUP BY 1""",
    "quality_cascade": """SELECT CASE WHEN l_quantity < 5.0 THEN 'dark' WHEN l_extendedprice / 100 < 30.0 THEN 'blurred' WHEN l_extendedprice / 100 < 200.0 AND l_discount * 10 > 0.4 THEN 'face' ELSE 'keep' END AS reason, count(*) AS n
FROM lineitem GROUP BY 1""",
    "frame_timestamps": f"""WITH {FRAMES}, n AS (SELECT frame_path, row_number() OVER (PARTITION BY video_path ORDER BY frame_num NULLS FIRST, frame_path) - 1 AS number FROM frames)
SELECT frame_path, number, number / 2.0 AS at FROM n""",
    "topk_cap": f"""WITH {FRAMES}, r AS (SELECT video_path, frame_path, row_number() OVER (PARTITION BY video_path ORDER BY {_DENSITY} DESC, timestamp_sec NULLS FIRST, frame_path) AS place FROM frames)
SELECT * FROM r WHERE place <= 10""",
    "unit_frames": f"""WITH {FRAMES}, r AS (
  SELECT unit_id, coalesce(nullif(selected_frame_path, ''), frame_path) AS path, row_number() OVER (PARTITION BY unit_id ORDER BY timestamp_sec NULLS LAST, frame_path) AS r FROM frames WHERE coalesce(unit_id, '') <> ''
) SELECT unit_id, count(*) AS n, string_agg(path, ',' ORDER BY r) AS paths FROM r GROUP BY 1""",
    "read_cues": f"""WITH {UNITS}, c AS (SELECT source_path, floor(span_start * 1000) / 1000 AS a, {strip("regexp_replace(coalesce(raw_text, ''), '[\\r\\n]+', ' ', 'g')")} AS t FROM units WHERE source_type = 'video' AND span_start >= 0 AND span_end >= 0)
SELECT source_path, count(*) AS n, round(sum(round(a, 3)), 3) AS starts, CAST(sum(length(t)) AS BIGINT) AS characters FROM c WHERE t <> '' GROUP BY 1""",
    "read_questions": "SELECT exam AS source_path, row_number() OVER (PARTITION BY exam ORDER BY item_id) - 1 AS unit_seq, CAST(0.95 AS DOUBLE) AS confidence, md5('Q: ' || text || chr(10) || 'A: ' || answer || chr(10) || 'Wrong: ' || exam || ', ' || lang) AS text_md5 FROM eval_items",
    "read_transcripts": f"""WITH {UNITS} SELECT source_path, row_number() OVER (PARTITION BY source_path ORDER BY unit_seq, unit_id) - 1 AS unit_seq, 'text' AS source_type, span_start, span_end, md5(coalesce(raw_text, '')) AS text_md5
FROM units WHERE source_type = 'video'""",
    "read_unknown_json": "SELECT exam AS source_path, CASE WHEN item_id % 3 = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END AS span_end, count(*) AS n, count_if(item_id % 3 = 0) AS empty FROM eval_items GROUP BY 1, 2",
    "read_texts": f"SELECT source_path, ordinal, text_md5 FROM (SELECT lpad(CAST(doc_id AS VARCHAR), 20, '0') AS source_path, row_number() OVER (ORDER BY lpad(CAST(doc_id AS VARCHAR), 20, '0')) - 1 AS ordinal, md5(text) AS text_md5, {strip('text')} AS t FROM documents) WHERE t <> ''",
    "read_json_lines": "SELECT DISTINCT unit_id, md5(raw_text) AS text_md5, span_start, true AS whole FROM (SELECT DISTINCT unit_id, raw_text, span_start FROM stage3_transcripts)",
    "visual_pages": "SELECT DISTINCT unit_id FROM stage3_transcripts WHERE source_type = 'pdf' AND coalesce(raw_text, '') = ''",
    "page_units": f"""WITH {UNITS}, p AS (SELECT source_path, unit_seq, raw_text, coalesce(len({words("raw_text")}), 0) AS n FROM units WHERE source_type = 'pdf'),
t AS (SELECT *, (row_number() OVER (PARTITION BY source_path ORDER BY unit_seq) - 1) // 3 AS chunk FROM p WHERE n >= 40)
SELECT source_path, min(unit_seq) AS unit_seq, min(unit_seq)::DOUBLE AS span_start, max(unit_seq)::DOUBLE AS span_end, md5(string_agg(raw_text, chr(10) || chr(10) ORDER BY unit_seq)) AS text_md5, '' AS images FROM t GROUP BY source_path, chunk
UNION ALL SELECT source_path, unit_seq, unit_seq::DOUBLE, unit_seq::DOUBLE, md5(''), source_path || '.png' FROM p WHERE n < 40 AND unit_seq % 2 = 0""",
    "video_units": f"""WITH {FRAMES}, p AS (SELECT video_path, max(timestamp_sec) AS duration, min(subtype) AS subtype FROM stage2_selected_frames WHERE length(video_path) % 2 = 0 GROUP BY 1)
SELECT DISTINCT f.video_path AS source_path, coalesce(p.subtype, 'unknown') AS video_subtype, coalesce(p.duration, 0.0) AS span_end FROM frames f LEFT JOIN p USING (video_path)""",
    "clusters_by_subtype": f"""WITH {FRAMES}, v AS (SELECT video_path, count(*) AS n, first(subtype ORDER BY timestamp_sec NULLS FIRST, frame_path) AS subtype FROM frames GROUP BY 1)
SELECT video_path, CAST(least(CASE subtype WHEN 'lecture' THEN 12 WHEN 'animation' THEN 30 WHEN 'lab' THEN 1 ELSE 25 END, n) AS BIGINT) AS k FROM v""",
    "languages_of_units": """SELECT DISTINCT unit_id, language, CASE language WHEN 'en' THEN 'small' ELSE 'multilingual' END AS embedder
FROM (SELECT unit_id, coalesce(nullif(regexp_extract(lower(trim(lang, ' ')), '^([^-_]*)', 1), ''), 'en') AS language FROM stage3_transcripts)""",
    "boundary_source": _SESSIONS + "SELECT unit_id FROM flagged WHERE new_source",
    "boundary_union": _SESSIONS + "SELECT unit_id FROM flagged WHERE boundary",
    "boundary_duration": "SELECT DISTINCT unit_id FROM stage3_transcripts WHERE span_end - span_start > 4",
    "text_embeddings": f"WITH {UNITS}, {embedded('units', 'unit_id', 'raw_text', 'vectors')} SELECT unit_id, CAST(place AS BIGINT) AS place, v > 0 AS up, dense_rank() OVER (PARTITION BY unit_id ORDER BY abs(v)) AS size FROM vectors",
    "segment_domains": f"""WITH {SEGS}, {embedded("segs", "segment_id", "merged_text", "vectors")},
seeds AS (SELECT unnest([{quoted(DOMAINS)}]) AS domain, generate_subscripts([{quoted(DOMAINS)}], 1) AS i), {embedded("seeds", "domain, i", "domain", "seed_vectors")},
s AS (SELECT segment_id, domain, i, sum(a.v * b.v) AS s FROM vectors a JOIN seed_vectors b USING (place) GROUP BY 1, 2, 3), best AS (
  SELECT segment_id, first(domain ORDER BY s DESC, i) AS domain, max(s) AS s FROM s WHERE s > 0 GROUP BY 1
) SELECT segs.segment_id, coalesce(best.domain, 'general') AS domain, round(coalesce(s, 0), 4) AS domain_confidence, round(coalesce(s, 0), 4) < 0.3 AS needs_llm_domain_check FROM segs LEFT JOIN best USING (segment_id)""",
    "transcript_fallback": f"""WITH {UNITS}, {SEGS}, spans AS (SELECT segment_id, span_start AS a, span_end AS b, source_paths[1] AS p FROM segs),
cues AS (SELECT source_path AS p, span_start AS a, span_end AS b, unit_seq, unit_id, {strip("coalesce(raw_text, '')")} AS t FROM units WHERE source_type = 'video'),
met AS (SELECT s.segment_id, count(*) AS n, string_agg(t, ' ' ORDER BY unit_seq, unit_id) FILTER (t <> '') AS t FROM spans s JOIN cues c ON c.p = s.p AND ((s.a = 0 AND s.b = 0) OR (c.b >= s.a AND c.a <= s.b)) GROUP BY 1),
whole AS (SELECT p, string_agg(t, ' ' ORDER BY unit_seq, unit_id) FILTER (t <> '') AS t FROM cues GROUP BY 1)
SELECT segment_id, md5(CASE WHEN met.n IS NOT NULL THEN coalesce(met.t, '') WHEN whole.p IS NOT NULL THEN coalesce(whole.t, '') END) AS text_md5
FROM spans LEFT JOIN met USING (segment_id) LEFT JOIN whole ON whole.p = spans.p""",
    "boundary_cosine": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, lag(CAST(embedding AS DOUBLE[])) OVER (PARTITION BY label ORDER BY vec_id) AS p FROM embeddings)
SELECT vec_id, round(list_inner_product(p, e), 6) AS similarity FROM v WHERE p IS NOT NULL AND list_inner_product(p, e) < 0""",
    "sessionize_capped": _SESSIONS + "SELECT unit_id, session, part FROM parts",
    "segment_rollup": _SESSIONS
    + f""", rows AS (SELECT *, {CONTEXT} AS context FROM parts)
SELECT chapter_id, session, part, min(span_start) AS span_start, max(span_end) AS span_end, count(*) AS unit_count, md5(string_agg(unit_id, ',' ORDER BY unit_seq, unit_id)) AS ids_md5,
  array_to_string(list_sort(list_distinct(list(source_type))), ',') AS source_types, md5(array_to_string(list_sort(list_distinct(list(source_path))), ',')) AS paths_md5,
  md5(coalesce(string_agg(context, ' ' ORDER BY unit_seq, unit_id) FILTER (context <> ''), '')) AS text_md5,
  coalesce(array_to_string((SELECT list(k ORDER BY q, i)[1:10] FROM (
    SELECT x.k AS k, min(x.q) AS q, min(x.i) AS i FROM (SELECT unnest(flatten(list(list_transform(coalesce(keyframe_paths, []), lambda k, i: {{'k': k, 'q': unit_seq, 'i': i}}) ORDER BY unit_seq, unit_id) FILTER (source_type = 'video'))) AS x) GROUP BY 1)), ','), '') AS keyframes
FROM rows GROUP BY 1, 2, 3""",
    "split_long_units": f"""WITH {UNITS}, w AS (
  SELECT unit_id, span_start, span_end - span_start AS duration, {words("coalesce(raw_text, '')")} AS w, CAST(floor((span_end - span_start) / 4.0) AS BIGINT) + 1 AS slices FROM units WHERE span_end - span_start > 4.0
), k AS (SELECT *, greatest(5, len(w) // slices) AS per, unnest(range(slices)) AS k FROM w), s AS (
  SELECT unit_id, k, span_start + k * (duration / slices) AS slice_start, span_start + (k + 1) * (duration / slices) AS slice_end,
    CASE WHEN k < slices - 1 THEN w[k * per + 1 : (k + 1) * per] ELSE w[k * per + 1 :] END AS p FROM k
) SELECT unit_id, k, round(slice_start, 6) AS slice_start, round(slice_end, 6) AS slice_end, md5(array_to_string(p, ' ')) AS slice_md5 FROM s WHERE len(p) > 0""",
    "validate_segments": f"""WITH {SEGS}, n AS (SELECT *, coalesce(len({words("merged_text")}), 0) AS n FROM segs)
SELECT segment_id, n AS n_words, CASE WHEN n < 20 THEN 'too_short' WHEN n > 1024 THEN 'too_long' WHEN coalesce(domain, '') = '' THEN 'no_domain' WHEN {strip("merged_text")} = '' THEN 'blank' ELSE 'ok' END AS reason FROM n""",
    "pending_antijoin": "SELECT DISTINCT unit_id FROM stage3_transcripts WHERE unit_id NOT IN (SELECT unit_id FROM stage2_selected_frames WHERE unit_id IS NOT NULL)",
    "parse_pass1": f"""WITH {_lines("stage6_raw_concepts", "concept_id")}
SELECT concept_id, p[1] AS name, CASE WHEN lower(p[2]) IN ({quoted(CONCEPT_TYPES)}) THEN lower(p[2]) ELSE 'fact' END AS type, md5(p[3]) AS definition_md5
FROM cut WHERE len(p) >= 3 AND length(p[1]) BETWEEN 1 AND 120 QUALIFY row_number() OVER (PARTITION BY concept_id ORDER BY line_no) <= 20""",
    "parse_pass2": f"""WITH {_lines("stage6_raw_relations", "relation_id")}, r AS (SELECT *, replace(lower(p[2]), ' ', '_') AS rel, coalesce(p[4], '') AS c FROM cut WHERE len(p) >= 3 AND p[1] <> '' AND p[3] <> '')
SELECT relation_id, p[1] AS source_name, CASE WHEN rel IN ({quoted(RELATIONS)}) THEN rel ELSE 'explains' END AS relation, p[3] AS target_name,
  coalesce(CASE WHEN lower(c) IN ('nan', '+nan', '-nan') THEN 1.0 WHEN regexp_full_match(c, '[+-]?([0-9][0-9_]*\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN greatest(0.0, least(1.0, try_cast(replace(c, '_', '') AS DOUBLE))) END, 0.8) AS confidence
FROM r QUALIFY row_number() OVER (PARTITION BY relation_id ORDER BY line_no) <= 20""",
    "parse_pass3": f"""WITH {_lines("stage6_raw_relations", "relation_id", "relation = 'requires'")}
SELECT relation_id, p[1] AS source_name, p[3] AS target_name, 0.85::DOUBLE AS confidence, true AS is_prereq FROM cut WHERE len(p) >= 3 AND p[1] <> '' AND p[3] <> ''
QUALIFY row_number() OVER (PARTITION BY relation_id ORDER BY line_no) <= 10""",
    "parse_qa": f"""WITH l AS (
  SELECT doc_id, line_no, {strip("line")} AS line FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '{LINE_END}')) AS line, generate_subscripts(regexp_split_to_array(text, '{LINE_END}'), 1) AS line_no
    FROM documents WHERE {strip("text")} LIKE 'Q:%' AND text LIKE '%A:%')
), g AS (SELECT doc_id, {_Q("Q:")} AS q, {_Q("A:")} AS a, substr(max_by(line, line_no) FILTER (line LIKE 'Wrong:%'), 7) AS w FROM l GROUP BY 1)
SELECT doc_id, md5(q) AS question_md5, md5(a) AS answer_md5, CAST(coalesce(len(list_filter(string_split(w, ','), lambda x: {strip("x")} <> '')), 0) AS BIGINT) AS n_wrong FROM g WHERE q <> '' AND a <> ''""",
    "extracted_concepts": f"""WITH {_EXTRACTED} SELECT segment_id, p[1] AS name, CASE WHEN lower(p[2]) IN ({quoted(CONCEPT_TYPES)}) THEN lower(p[2]) ELSE 'fact' END AS type, md5(p[3]) AS definition_md5, 1.0::DOUBLE AS confidence FROM pass1
UNION ALL SELECT segment_id, substr(q, 1, 100), 'fact', md5(a), 0.9 FROM qa UNION ALL SELECT segment_id, substr(w, 1, 80), 'example', md5(''), 0.6 FROM wrong""",
    "extracted_relations": f"""WITH {_EXTRACTED}, r AS (SELECT *, replace(lower(p[2]), ' ', '_') AS rel, coalesce(p[4], '') AS c FROM cut2 WHERE len(p) >= 3 AND p[1] <> '' AND p[3] <> '')
SELECT segment_id, p[1] AS source_name, CASE WHEN rel IN ({quoted(RELATIONS)}) THEN rel ELSE 'explains' END AS relation, p[3] AS target_name,
  coalesce(CASE WHEN lower(c) IN ('nan', '+nan', '-nan') THEN 1.0 WHEN regexp_full_match(c, '[+-]?([0-9][0-9_]*\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN greatest(0.0, least(1.0, try_cast(replace(c, '_', '') AS DOUBLE))) END, 0.8) AS confidence, CAST(NULL AS BOOLEAN) AS is_prereq
FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY line_no) <= 20) WHERE segment_id IN (SELECT segment_id FROM pass1)
UNION ALL SELECT segment_id, p[1], 'requires', p[3], 0.85, true FROM (SELECT * FROM cut3 WHERE len(p) >= 3 AND p[1] <> '' AND p[3] <> '' QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY line_no) <= 10) WHERE segment_id IN (SELECT segment_id FROM pass1)
UNION ALL SELECT segment_id, substr(q, 1, 100), 'contrasts_with', substr(w, 1, 80), 0.7, false FROM wrong""",
    "think_strip": f"SELECT DISTINCT concept_id, md5({strip('raw_line')}) AS reply_md5 FROM stage6_raw_concepts",
    "digits_clamp": "SELECT p_partkey, greatest(1, least(5, coalesce(try_cast(regexp_replace(p_brand, '[^0-9]', '', 'g') AS BIGINT), 2))) AS level FROM part",
    "topic_lines": f"""WITH {_lines("stage6_raw_concepts", "concept_id")}
SELECT concept_id, substr(p[1], 1, 80) AS title, coalesce(p[2], '') AS summary, array_to_string({_NAMED}[1:3], '|') AS top_concepts, greatest(1, least(5, coalesce(try_cast(regexp_replace(coalesce(p[4], ''), '[^0-9]', '', 'g') AS INT), 2)))::BIGINT AS difficulty
FROM cut QUALIFY row_number() OVER (PARTITION BY concept_id ORDER BY line_no) = 1""",
    "chapter_lines": f"""WITH {_lines("stage6_raw_concepts", "concept_id")}
SELECT concept_id, substr(p[1], 1, 100) AS title, md5(coalesce(p[2], '')) AS summary, array_to_string({_NAMED}, '|') AS domains FROM cut QUALIFY row_number() OVER (PARTITION BY concept_id ORDER BY line_no) = 1""",
    "normalize_names": f"SELECT DISTINCT concept_id, regexp_replace(lower({strip('name')}), '[^a-z0-9 ]', '', 'g') AS norm, {name('name')} AS form FROM stage6_raw_concepts",
    "exact_name_groups": f"WITH {RAW} SELECT chapter_id, form, min(concept_seq) AS first_seq, count(*) AS n FROM raw GROUP BY 1, 2",
    "canonical_concepts": _CANONICAL + _shown("form"),
    "id_remap": _CANONICAL + _REMAP,
    "fuzzy_pairs": f"WITH named AS (SELECT chapter_id, lower(name) AS norm, min(concept_seq) AS seq FROM stage6_raw_concepts WHERE name IS NOT NULL GROUP BY 1, 2), {_similar('named')} SELECT chapter_id, seq_a, seq_b, round(ratio, 6) AS ratio FROM pairs",
    "leader_groups": _LEXICAL + "SELECT concept_id, leader AS leader_seq FROM lexical",
    "mode_names": _LEXICAL
    + """SELECT chapter_id, leader AS leader_seq, first(name ORDER BY n DESC, q) AS name, max(n) AS n FROM (
  SELECT chapter_id, leader, name, count(*) AS n, min(concept_seq) AS q FROM raw JOIN lexical USING (concept_id) GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    "fuzzy_concepts": _FUZZY + _shown("leader_seq"),
    "fuzzy_remap": _FUZZY + _REMAP,
    "remap_concepts": """WITH m AS (SELECT old_id, min(canonical_id) AS new FROM stage7_id_remap WHERE old_id IS NOT NULL AND canonical_id IS NOT NULL GROUP BY 1)
SELECT coalesce(new, concept_id) AS concept_id, concept_seq FROM (SELECT DISTINCT concept_id, concept_seq FROM stage6_raw_concepts) LEFT JOIN m ON old_id = concept_id""",
    "name_resolve_first": f"WITH {RELS}, {CANON}, {_INDEX}, {_RESOLVED} SELECT relation_id, s1 AS source, t1 AS target FROM resolved",
    "name_resolve_last": f"WITH {RELS}, {CANON}, {_INDEX}, {_RESOLVED} SELECT relation_id, s2 AS source, t2 AS target FROM resolved",
    "edge_dedup_max": _PREREQS + "SELECT * FROM edges",
    "prereq_depths": _DEPTHS + "SELECT * FROM depths",
    "depth_histogram": _DEPTHS + "SELECT depth, count(*) AS n FROM depths GROUP BY 1",
    "learning_order": _DEPTHS + "SELECT chapter_id, node, row_number() OVER (PARTITION BY chapter_id ORDER BY depth, node) - 1 AS place FROM depths",
    "temporal_prereqs": f"""SELECT b.vec_id AS source, a.vec_id AS target, round(0.7 * {_DOT}, 6) AS confidence FROM embeddings a JOIN embeddings b ON a.label < b.label WHERE {_DOT} >= 0.3
ORDER BY round({_DOT}, 9) DESC, source, target LIMIT 201""",
    "domain_argmax": f"""WITH seeds AS (SELECT label % 10 AS place, ([{quoted(DOMAINS)}])[label % 10 + 1] AS seed, min_by(embedding, vec_id) AS embedding FROM embeddings GROUP BY 1, 2),
s AS (SELECT a.vec_id, b.seed, b.place, {_DOT} AS s FROM embeddings a, seeds b)
SELECT vec_id, coalesce(first(seed ORDER BY s DESC, place) FILTER (s > 0), 'general') AS seed, round(coalesce(max(s) FILTER (s > 0), 0.0), 6) AS similarity FROM s GROUP BY 1""",
    "cluster_min_sim": f"""WITH m AS (SELECT a.label, min({_DOT}) AS m FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY 1), n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT label, n, round(coalesce(m, 1.0), 6) AS least, CASE WHEN coalesce(m, 1.0) >= 0.9 THEN 'merge' WHEN coalesce(m, 1.0) >= -0.45 THEN 'check' ELSE 'split' END AS fate FROM n LEFT JOIN m USING (label)""",
    "topic_difficulty": f"WITH {CANON} SELECT chapter_id, domain, CAST(greatest(1, least(5, CAST(trunc(avg(difficulty)) AS BIGINT) + 1)) AS BIGINT) AS difficulty, count(*) AS n FROM canon GROUP BY 1, 2",
    "graph_nodes": _GRAPH
    + _LEVELS
    + """SELECT n.id, n.type, label, domain, chapter_id, frequency, n_evidence, concept_type, md5(definition) AS definition, round(confidence, 6) AS confidence,
  CASE n.type WHEN 'AtomicConcept' THEN l.level + 1 WHEN 'TopicGodNode' THEN t.level END AS difficulty, l.level AS depth_level, md5(array_to_string(aliases, '|')) AS aliases, md5(array_to_string(evidence, '|')) AS evidence
FROM nodes n LEFT JOIN levels l ON l.id = n.id LEFT JOIN topic_levels t ON t.id = n.id""",
    "graph_edges": _GRAPH + "SELECT source, target, type, round(confidence, 6) AS confidence, cross_domain, chapter_id FROM links",
    "cross_domain_edges": _RAW_GRAPH + "SELECT type, count(*) AS n FROM links WHERE cross_domain GROUP BY 1",
    "domains_present": _RAW_GRAPH + "SELECT DISTINCT chapter_id, domain FROM atomic WHERE domain <> ''",
    "concept_texts": _GRAPH + "SELECT id, md5(coalesce(label, '') || ': ' || coalesce(definition, '')) AS text_md5 FROM atomic",
    "quality_gates": _GRAPH
    + """, ends AS (SELECT source AS id FROM links UNION SELECT target FROM links), seen AS (SELECT nodes.id, type, chapter_id, n_evidence, ends.id IS NULL AS alone FROM nodes LEFT JOIN ends USING (id)), n AS (
  SELECT chapter_id, count_if(type = 'AtomicConcept') AS concepts, count(*) AS n, count_if(alone) AS orphans, count_if(type = 'AtomicConcept' AND n_evidence = 0) AS bare, count_if(type = 'TopicGodNode') AS topics,
    coalesce(array_to_string((list(id ORDER BY id) FILTER (alone))[1:10], ','), '') AS lonely, coalesce(array_to_string((list(id ORDER BY id) FILTER (type = 'AtomicConcept' AND n_evidence = 0))[1:10], ','), '') AS unseen
  FROM seen GROUP BY 1
), m AS (SELECT chapter_id, count(*) AS edges FROM links GROUP BY 1), a AS (
  SELECT n.*, coalesce(edges, 0) AS edges, orphans / greatest(n, 1) AS ratio, 1 - bare / greatest(concepts, 1) AS covered FROM n LEFT JOIN m USING (chapter_id)
), inner_links AS (SELECT DISTINCT chapter_id, source, target FROM links WHERE type NOT IN ('has_topic', 'contains', 'appears_in')),
around AS (SELECT chapter_id, source AS a, target AS b FROM inner_links UNION SELECT r.chapter_id, r.a, e.target FROM around r JOIN inner_links e ON e.chapter_id = r.chapter_id AND e.source = r.b),
c AS (SELECT chapter_id, NOT EXISTS (SELECT 1 FROM reach r WHERE r.chapter_id = a.chapter_id AND r.a = r.b) AS dag, NOT EXISTS (SELECT 1 FROM around r WHERE r.chapter_id = a.chapter_id AND r.a = r.b) AS whole FROM a), checks AS (
  SELECT chapter_id, 'min_concepts' AS "check", round(concepts::DOUBLE, 6) AS value, 10.0::DOUBLE AS threshold, concepts >= 10 AS passed, '' AS sample FROM a
  UNION ALL SELECT chapter_id, 'min_edges', edges::DOUBLE, 10.0, edges >= 10, '' FROM a
  UNION ALL SELECT chapter_id, 'orphan_ratio', round(ratio, 6), 0.2, ratio <= 0.2, lonely FROM a
  UNION ALL SELECT chapter_id, 'evidence_coverage', round(covered, 6), 0.9, covered >= 0.9, unseen FROM a
  UNION ALL SELECT chapter_id, 'topics', topics::DOUBLE, 3.0, topics >= 3, '' FROM a
  UNION ALL SELECT chapter_id, 'dag_acyclic', dag::INT::DOUBLE, 1.0, dag, '' FROM c
  UNION ALL SELECT chapter_id, 'graph_acyclic', whole::INT::DOUBLE, 1.0, whole, '' FROM c
) SELECT *, bool_and(passed) OVER (PARTITION BY chapter_id) AS all_passed FROM checks""",
    "induced_overview": _induced("type IN ('Chapter', 'TopicGodNode')"),
    "induced_domain": _induced("domain = 'mechanics'"),
    "induced_concepts": _induced("type = 'AtomicConcept'"),
    "requires_view": _induced("type = 'AtomicConcept'", "type = 'requires'", "source, target"),
    "export_views": _GRAPH
    + """, ends AS (SELECT source AS id FROM links WHERE type = 'requires' UNION SELECT target FROM links WHERE type = 'requires'), members AS (
  SELECT chapter_id, 'overview' AS view, id FROM nodes WHERE type IN ('Chapter', 'TopicGodNode') UNION ALL SELECT chapter_id, 'concepts', id FROM atomic
  UNION ALL SELECT chapter_id, 'prerequisites', id FROM nodes WHERE id IN (SELECT id FROM ends)
  UNION ALL SELECT n.chapter_id, 'domain:' || n.domain, n.id FROM nodes n WHERE (n.chapter_id, n.domain) IN (SELECT chapter_id, domain FROM atomic WHERE domain <> '')
), sizes AS (SELECT chapter_id, view, count(*) AS n_nodes FROM members GROUP BY 1, 2), inside AS (
  SELECT t.chapter_id, t.view, count(*) AS n_edges FROM links l JOIN members s ON s.id = l.source JOIN members t ON t.id = l.target AND t.view = s.view WHERE t.view <> 'prerequisites' OR l.type = 'requires' GROUP BY 1, 2
), big AS (SELECT chapter_id, count(*) >= 3 AS rendered FROM nodes GROUP BY 1)
SELECT chapter_id, view, CASE view WHEN 'overview' THEN 'Chapter Overview' WHEN 'concepts' THEN 'Full Concept Graph' WHEN 'prerequisites' THEN 'Learning Path' ELSE upper(view[8:8]) || view[9:] || ' Topic' END AS title,
  n_nodes, coalesce(n_edges, 0) AS n_edges, rendered FROM sizes LEFT JOIN inside USING (chapter_id, view) JOIN big USING (chapter_id)""",
    "graph_summary": _GRAPH
    + f""", got AS (SELECT 'node' AS kind, type, count(*) AS n FROM nodes GROUP BY 2 UNION ALL SELECT 'edge', type, count(*) FROM links GROUP BY 2),
fixed AS (SELECT 'node' AS kind, unnest([{quoted(NODE_TYPES)}]) AS type UNION ALL SELECT 'edge', unnest([{quoted(SUMMARY_EDGES)}]))
SELECT kind, type, coalesce(n, 0) AS n FROM fixed LEFT JOIN got USING (kind, type)""",
    "triples": _GRAPH
    + "SELECT coalesce(nullif(s.label, ''), l.source) AS subject, l.type AS predicate, coalesce(nullif(t.label, ''), l.target) AS object FROM links l LEFT JOIN nodes s ON s.id = l.source LEFT JOIN nodes t ON t.id = l.target",
    "node_style": _GRAPH
    + _LEVELS
    + f""", o AS (SELECT nodes.*, CASE type WHEN 'AtomicConcept' THEN frequency ELSE 1 END AS often, coalesce(level, 0) AS level FROM nodes LEFT JOIN levels USING (id))
SELECT id, CAST({_BY("type", SIZES, 15)} + least(20, 2 * often) AS BIGINT) AS size, substr(label, 1, {_BY("type", CUTS, 40)}) AS caption, {_BY("domain", DOMAIN_COLORS, NO_DOMAIN)} AS color, CAST({_BY("type", BORDERS, 1)} AS BIGINT) AS border,
  CASE type WHEN 'AtomicConcept' THEN 'dot' ELSE 'box' END AS shape, md5(CASE type WHEN 'AtomicConcept' THEN '<b>' || coalesce(label, '') || '</b><br>Type: ' || coalesce(concept_type, '') || '<br>Domain: ' || domain || '<br>Depth: ' || level || '<br>Frequency: ' || often ||
    CASE WHEN coalesce(definition, '') <> '' THEN '<br><i>' || substr(definition, 1, 120) || '</i>' ELSE '' END WHEN 'Source' THEN '' ELSE '<b>' || coalesce(label, '') || '</b>' END) AS tooltip FROM o""",
    "edge_style": _GRAPH + f"SELECT source, target, type, round(greatest(1.0, 4 * confidence), 6) AS width, cross_domain AS dashed, {_BY('type', EDGE_COLORS, NO_EDGE)} AS color, printf('%s (%.2f)', type, round(confidence, 2)) AS title FROM links",
    "acyclic_chapters": _DEPTHS + "SELECT chapter_id, NOT EXISTS (SELECT 1 FROM reach r WHERE r.chapter_id = e.chapter_id AND r.a = r.b) AS before, true AS after FROM (SELECT DISTINCT chapter_id FROM edges) e",
    "greedy_keep_first": f"""WITH RECURSIVE items AS (SELECT 0 AS scope, vec_id AS seq FROM embeddings), pairs AS MATERIALIZED (SELECT 0 AS scope, a.vec_id AS seq_a, b.vec_id AS seq_b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_DOT} >= 0.35), {_WALK}
SELECT seq AS vec_id, leader FROM walk""",
    "temporal_concepts": f"""WITH RECURSIVE {RELS}, {CANON}, {_INDEX}, {_RESOLVED}, {_EDGES}, {embedded("canon", "concept_id", "name", "vectors")},
spots AS (SELECT segment_id, min(segment_index) AS i FROM stage5_segments GROUP BY 1), spans AS (
  SELECT concept_id, any_value(chapter_id) AS chapter_id, min(i) AS lo, max(i) AS hi FROM (SELECT concept_id, chapter_id, unnest(source_segments) AS segment_id FROM canon) JOIN spots USING (segment_id) GROUP BY 1
), likeness AS MATERIALIZED (
  SELECT a.concept_id AS x, b.concept_id AS y, p.chapter_id, sum(a.v * b.v) AS s FROM vectors a JOIN spans p ON p.concept_id = a.concept_id JOIN vectors b ON b.place = a.place AND b.concept_id <> a.concept_id JOIN spans q ON q.concept_id = b.concept_id AND q.chapter_id = p.chapter_id GROUP BY 1, 2, 3
)
SELECT l.chapter_id, x AS source, y AS target, round(0.7 * s, 6) AS confidence FROM likeness l JOIN spans p ON p.concept_id = x JOIN spans q ON q.concept_id = y
WHERE s >= 0.75 AND q.lo < p.hi AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.chapter_id = l.chapter_id AND e.source = x AND e.target = y)
QUALIFY row_number() OVER (PARTITION BY l.chapter_id ORDER BY round(s, 9) DESC, x, y) <= 201""",
}
