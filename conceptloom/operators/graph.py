"""The concept graph: nodes, edges, gates, views, summaries and triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptloom.config import DEFAULTS, NODE_TYPES, RELATIONS, EngineConfig
from conceptloom.operators.prereqs import acyclic, is_prerequisite, prerequisite_edges
from conceptloom.operators.resolve import resolved_relations
from conceptloom.runtime import Scratch


def live_concepts(canonical: DataFrame) -> DataFrame:
    """Canonical concepts that aren't deleted, one row for each id, without a domain as 'general'."""
    domain = F.coalesce(F.nullif(F.col("domain"), F.lit("")), F.lit("general"))
    return canonical.filter(F.col("deleted_at").isNull()).dropDuplicates(["concept_id"]).withColumn("domain", domain)


def graph_nodes(canonical: DataFrame, units: DataFrame, depths: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """(id, type, label, domain, chapter_id, frequency, n_evidence, concept_type, definition, confidence, difficulty, depth_level,
    aliases, evidence): chapters, topics, concepts and sources.

    depths (node, depth) give a concept's depth level, 0 where there is none, and its difficulty, one more. members
    (chapter_id, domain, topic, title, concept_id) say which concepts a topic holds; by default each domain of a chapter is
    one. A topic's difficulty is that of its concepts' average depth, between 1 and 5.
    """
    concepts = live_concepts(canonical)
    members = domain_members(concepts) if members is None else members
    if depths is not None:
        concepts = concepts.join(depths.filter("depth >= 0").groupBy(F.col("node").alias("concept_id")).agg(F.max("depth").alias("__depth")), "concept_id", "left")
    else:
        concepts = concepts.withColumn("__depth", F.lit(0))
    depth = F.coalesce("__depth", F.lit(0)).cast("long")
    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    none, nowhere = F.lit(None).cast("array<string>"), F.lit(0).cast("long")
    atomic = concepts.select(
        F.col("concept_id").alias("id"), F.lit("AtomicConcept").alias("type"), F.col("name").alias("label"), "domain", "chapter_id", F.coalesce("frequency", F.lit(1)).cast("long").alias("frequency"),
        F.coalesce(F.size("source_segments"), F.lit(0)).cast("long").alias("n_evidence"), F.col("type").alias("concept_type") if "type" in canonical.columns else text.alias("concept_type"),
        (F.col("definition") if "definition" in canonical.columns else text).alias("definition"), (F.col("confidence") if "confidence" in canonical.columns else F.lit(None).cast("double")).alias("confidence"),
        (depth + 1).alias("difficulty"), depth.alias("depth_level"), F.col("aliases"), F.col("source_segments").alias("evidence"),
    )
    rest = lambda df, difficulty: df.select(
        "id", "type", "label", "domain", "chapter_id", "frequency", nowhere.alias("n_evidence"), text.alias("concept_type"), text.alias("definition"), F.lit(None).cast("double").alias("confidence"),
        difficulty.alias("difficulty"), number.alias("depth_level"), none.alias("aliases"), none.alias("evidence"),
    )
    deep = members.join(atomic.select(F.col("id").alias("concept_id"), "depth_level"), "concept_id")
    topics = deep.groupBy("chapter_id", "domain", "topic").agg(F.min("title").alias("label"), F.count(F.lit(1)).alias("frequency"), F.avg("depth_level").alias("__a"))
    topics = topics.withColumns({"id": topic_id(), "type": F.lit("TopicGodNode")})
    chapters = atomic.groupBy("chapter_id").agg(F.count(F.lit(1)).alias("frequency")).withColumns({"id": F.concat(F.lit("chapter:"), F.col("chapter_id")), "type": F.lit("Chapter"), "label": F.col("chapter_id"), "domain": text})
    sources = units.filter(F.col("source_path") != "").groupBy("source_path").agg(F.min("chapter_id").alias("chapter_id"), F.count_distinct("unit_id").alias("frequency"))
    sources = sources.withColumns({"id": source_id("source_path"), "type": F.lit("Source"), "label": F.regexp_extract("source_path", "([^/]*)$", 1), "domain": text})
    level = F.greatest(F.lit(1), F.least(F.lit(5), F.col("__a").cast("int") + 1)).cast("long")
    return atomic.unionByName(rest(topics, level)).unionByName(rest(chapters, number)).unionByName(rest(sources, number))


def source_id(path: str) -> Column:
    return F.sha2(F.concat(F.lit("source:"), F.col(path)), 256)


def topic_id() -> Column:
    """Of a topic's chapter, domain and number; one without a number is the domain's only topic."""
    return F.concat_ws("/", "chapter_id", "domain", "topic")


def domain_members(concepts: DataFrame) -> DataFrame:
    """Each domain of a chapter as one topic."""
    return concepts.select("chapter_id", "domain", F.lit(None).cast("string").alias("topic"), F.col("domain").alias("title"), "concept_id")


def graph_edges(nodes: DataFrame, relations: DataFrame, canonical: DataFrame, dag: DataFrame | None = None, members: DataFrame | None = None, segments: DataFrame | None = None) -> DataFrame:
    """(source, target, type, confidence, cross_domain, chapter_id): has_topic, contains, requires and other relations between
    nodes that exist; of parallel edges of one type the best confidence. With a dag, its edges are the requires edges
    instead of all prerequisites; with members the topics hold those concepts; with segments (segment_id, source_paths)
    a concept appears_in the sources of the segments that it was seen in."""
    live = live_concepts(canonical)
    members = domain_members(live) if members is None else members
    concept = nodes.filter("type = 'AtomicConcept'").select("id", "chapter_id", "domain")
    has = nodes.filter("type = 'TopicGodNode'").select(F.concat(F.lit("chapter:"), F.col("chapter_id")).alias("source"), F.col("id").alias("target"), F.lit("has_topic").alias("type"), F.lit(1.0).alias("confidence"), "chapter_id")
    contains = members.select(topic_id().alias("source"), F.col("concept_id").alias("target"), F.lit("contains").alias("type"), F.lit(1.0).alias("confidence"), "chapter_id")
    requires = (prerequisite_edges(relations, live) if dag is None else dag).select("source", "target", F.lit("requires").alias("type"), "confidence", "chapter_id")
    other = resolved_relations(relations.filter(~is_prerequisite()), live, last=True).filter((F.col("source") != F.col("target")) & F.col("relation").isin(RELATIONS))
    sure = F.coalesce(F.nanvl("confidence", F.lit(None)), F.lit(0.0))
    semantic = other.groupBy("source", "target", F.col("relation").alias("type"), "chapter_id").agg(F.max(sure).alias("confidence"))
    edges = has.unionByName(contains).unionByName(requires).unionByName(semantic.select("source", "target", "type", "confidence", "chapter_id"))
    d = lambda x: concept.select(F.col("id").alias(x), F.col("domain").alias(f"d_{x}"))
    out = edges.join(d("source"), "source", "left").join(d("target"), "target", "left").select(
        "source", "target", "type", "confidence", F.coalesce((F.col("d_source") != "") & (F.col("d_target") != "") & (F.col("d_source") != F.col("d_target")), F.lit(False)).alias("cross_domain"), "chapter_id"
    )
    if segments is None:
        return out
    paths = segments.select("segment_id", F.explode(F.array_distinct("source_paths")).alias("path")).filter(F.col("path") != "").distinct()
    seen = live.select(F.col("concept_id").alias("source"), "chapter_id", F.explode(F.array_distinct("source_segments")).alias("segment_id")).join(paths, "segment_id").select("source", source_id("path").alias("target"), "chapter_id").distinct()
    there = nodes.filter("type = 'Source'").select(F.col("id").alias("target"))
    appears = seen.join(there, "target", "left_semi").select("source", "target", F.lit("appears_in").alias("type"), F.lit(1.0).alias("confidence"), F.lit(False).alias("cross_domain"), "chapter_id")
    return out.unionByName(appears)


def induced(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    return edges.join(nodes.select(F.col("id").alias("source")), "source", "left_semi").join(nodes.select(F.col("id").alias("target")), "target", "left_semi")


def quality_gates(nodes: DataFrame, edges: DataFrame, scope: str = "chapter_id", config: EngineConfig = DEFAULTS, most: int = 10) -> DataFrame:
    """(scope, check, value, threshold, passed, sample, all_passed) for each scope: the gates on numbers, with the smallest ids of
    what fails as a sample of at most ``most``, whether the requires edges and whether all edges are free of cycles (no edges
    are), and whether the scope passes every check."""
    scratch = Scratch(nodes.sparkSession, "gates")
    ends = edges.select(F.explode(F.array("source", "target")).alias("id")).distinct().withColumn("linked", F.lit(True))
    rows = scratch.save(nodes.select("id", "type", scope, "n_evidence").join(ends, "id", "left"), "rows")
    is_concept = F.col("type") == "AtomicConcept"
    bare, alone = is_concept & (F.col("n_evidence") == 0), F.col("linked").isNull()
    n = rows.groupBy(scope).agg(F.count_if(is_concept).alias("concepts"), F.count(F.lit(1)).alias("n"), F.count_if(alone).alias("orphans"), F.count_if(bare).alias("bare"), F.count_if(F.col("type") == "TopicGodNode").alias("topics"))
    m = edges.groupBy(scope).agg(F.count(F.lit(1)).alias("edges"))

    def sample(which: Column, name: str) -> DataFrame:
        first = rows.filter(which).withColumn("r", F.row_number().over(Window.partitionBy(scope).orderBy("id"))).filter(F.col("r") <= most)
        return first.groupBy(scope).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "id"))), lambda x: x.id), ",").alias(name))

    all_ = n.join(m, scope, "left").join(sample(alone, "lonely"), scope, "left").join(sample(bare, "unseen"), scope, "left").withColumn("edges", F.coalesce("edges", F.lit(0)))

    def check(name: str, value: Column, threshold: float, passed: Column, some: str | None = None) -> Column:
        shown = F.coalesce(F.col(some) if some else F.lit(None).cast("string"), F.lit(""))
        return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"), passed.alias("passed"), shown.alias("sample"))

    ratio = F.col("orphans") / F.greatest(F.col("n"), F.lit(1))
    covered = 1 - F.col("bare") / F.greatest(F.col("concepts"), F.lit(1))
    checks = F.array(
        check("min_concepts", F.col("concepts"), config.min_concepts, F.col("concepts") >= config.min_concepts),
        check("min_edges", F.col("edges"), config.min_edges, F.col("edges") >= config.min_edges),
        check("orphan_ratio", ratio, config.max_orphan_ratio, ratio <= config.max_orphan_ratio, "lonely"),
        check("evidence_coverage", covered, config.min_coverage, covered >= config.min_coverage, "unseen"),
        check("topics", F.col("topics"), 3, F.col("topics") >= 3),
    )
    out = gates = scratch.save(all_.select(scope, F.explode(checks).alias("c")).select(scope, "c.*"), "gates")
    scopes = gates.select(scope).distinct()
    for name, some in (("dag_acyclic", edges.filter("type = 'requires'")), ("graph_acyclic", edges)):
        free = F.coalesce("acyclic", F.lit(True))
        out = out.unionByName(scopes.join(acyclic(some, scope), scope, "left").select(scope, F.lit(name).alias("check"), free.cast("double").alias("value"), F.lit(1.0).alias("threshold"), free.alias("passed"), F.lit("").alias("sample")))
    return out.withColumn("all_passed", F.bool_and("passed").over(Window.partitionBy(scope)))


# The types of edges that the summary counts.
SUMMARY_EDGES = ["requires", "explains", "leads_to", "example_of", "contains", "has_topic"]


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, type, n) over the fixed lists of types, with zeros; other types are not listed."""
    fixed = lambda kind, types: nodes.sparkSession.createDataFrame([(kind, t) for t in types], "kind string, type string")
    count = lambda df, kind: df.groupBy("type").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
    got = count(nodes, "node").unionByName(count(edges, "edge"))
    return fixed("node", NODE_TYPES).unionByName(fixed("edge", SUMMARY_EDGES)).join(got, ["kind", "type"], "left").select("kind", "type", F.coalesce("n", F.lit(0)).alias("n"))


def domains_present(nodes: DataFrame) -> DataFrame:
    """(chapter_id, domain) of the concepts."""
    return nodes.filter("type = 'AtomicConcept' AND domain <> ''").select("chapter_id", "domain").distinct()


def concept_texts(nodes: DataFrame) -> DataFrame:
    """(id, text): each concept's name and definition, as a text to be indexed."""
    return nodes.filter("type = 'AtomicConcept'").select("id", F.concat(F.coalesce("label", F.lit("")), F.lit(": "), F.coalesce("definition", F.lit(""))).alias("text"))


def export_views(nodes: DataFrame, edges: DataFrame, least: int = 3) -> DataFrame:
    """(chapter_id, view, title, n_nodes, n_edges, rendered): the views of each chapter. overview holds its chapter and topics, a
    domain's view the nodes of that domain, prerequisites the ends of requires edges, concepts all concepts; a chapter of
    fewer than ``least`` nodes gets a summary alone."""
    small = nodes.groupBy("chapter_id").agg((F.count(F.lit(1)) >= least).alias("rendered"))
    ends = edges.filter("type = 'requires'").select(F.explode(F.array("source", "target")).alias("id")).distinct()
    base = nodes.select("chapter_id", "id", "type", "domain")
    view = lambda df, name: df.select("chapter_id", F.lit(name).alias("view") if isinstance(name, str) else name.alias("view"), "id")
    parts = [
        view(base.filter("type in ('Chapter', 'TopicGodNode')"), "overview"), view(base.filter("type = 'AtomicConcept'"), "concepts"), view(base.join(ends, "id", "left_semi"), "prerequisites"),
        view(base.join(domains_present(nodes), ["chapter_id", "domain"], "left_semi"), F.concat(F.lit("domain:"), F.col("domain"))),
    ]
    members = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    size = members.groupBy("chapter_id", "view").agg(F.count(F.lit(1)).alias("n_nodes"))
    met = edges.select("source", "target", "type").join(members.select("view", F.col("id").alias("source")), "source").join(members.select("chapter_id", "view", F.col("id").alias("target")), ["view", "target"])
    links = met.filter("view <> 'prerequisites' OR type = 'requires'").groupBy("chapter_id", "view").agg(F.count(F.lit(1)).alias("n_edges"))
    # Titles of the views.
    title = F.when(F.col("view") == "overview", "Chapter Overview").when(F.col("view") == "concepts", "Full Concept Graph").when(F.col("view") == "prerequisites", "Learning Path").otherwise(F.concat(F.initcap(F.substring("view", 8, 1000)), F.lit(" Topic")))
    return size.join(links, ["chapter_id", "view"], "left").join(small, "chapter_id").select("chapter_id", "view", title.alias("title"), "n_nodes", F.coalesce("n_edges", F.lit(0)).alias("n_edges"), "rendered")


def triples(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(subject, predicate, object): labels instead of ids where there are any."""
    label = lambda x: nodes.select(F.col("id").alias(x), F.nullif(F.col("label"), F.lit("")).alias(f"l_{x}"))
    return edges.join(label("source"), "source", "left").join(label("target"), "target", "left").select(
        F.coalesce("l_source", "source").alias("subject"), F.col("type").alias("predicate"), F.coalesce("l_target", "target").alias("object")
    )


# Sizes, borders and lengths of captions of node types in views; colours of domains and of edges.
SIZES = {"Chapter": 60, "TopicGodNode": 35, "AtomicConcept": 15, "Source": 10}
BORDERS = {"Chapter": 4, "TopicGodNode": 3, "AtomicConcept": 1, "Source": 1}
CUTS = {"Chapter": 40, "TopicGodNode": 35, "AtomicConcept": 40, "Source": 30}
DOMAIN_COLORS = {
    "optics": "#4FC3F7", "mechanics": "#EF9A9A", "chemistry": "#A5D6A7", "electricity": "#FFE082", "thermodynamics": "#FFAB91", "waves": "#CE93D8", "quantum": "#80DEEA", "biology": "#C5E1A5",
    "mathematics": "#F48FB1", "general": "#B0BEC5",
}
EDGE_COLORS = {
    "requires": "#E53935", "explains": "#1E88E5", "leads_to": "#43A047", "example_of": "#FB8C00", "contains": "#757575", "has_topic": "#5E35B1", "contrasts_with": "#D81B60", "formula_for": "#00ACC1",
    "part_of": "#6D4C41", "applied_in": "#558B2F", "appears_in": "#9E9E9E",
}
NO_DOMAIN, NO_EDGE = "#CFD8DC", "#888"


def by_value(column: str, table: dict, other) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(F.col(column) == k, v) if out is None else out.when(F.col(column) == k, v)
    return out.otherwise(other)


def node_style(nodes: DataFrame) -> DataFrame:
    """(id, size, caption, color, border, shape, tooltip): size grows with the frequency up to 20 more, captions are cut by type."""
    # Only concepts carry a frequency of their own; other nodes count once.
    often = F.when(F.col("type") == "AtomicConcept", F.coalesce("frequency", F.lit(1))).otherwise(1)
    said = F.coalesce("definition", F.lit(""))
    line = lambda name, c: F.concat(F.lit(f"{name}: "), F.coalesce(c.cast("string"), F.lit("")))
    concept = F.concat_ws(
        "<br>", F.concat(F.lit("<b>"), F.coalesce("label", F.lit("")), F.lit("</b>")), line("Type", F.col("concept_type")), line("Domain", F.col("domain")), line("Depth", F.coalesce("depth_level", F.lit(0))), line("Frequency", often),
        F.when(said != "", F.concat(F.lit("<i>"), F.substring(said, 1, 120), F.lit("</i>"))),
    )
    tooltip = F.when(F.col("type") == "AtomicConcept", concept).when(F.col("type").isin("Chapter", "TopicGodNode"), F.concat(F.lit("<b>"), F.coalesce("label", F.lit("")), F.lit("</b>"))).otherwise("")
    return nodes.select(
        "id", (by_value("type", SIZES, 15) + F.least(F.lit(20), 2 * often)).cast("long").alias("size"), F.substring("label", F.lit(1), by_value("type", CUTS, 40)).alias("caption"), by_value("domain", DOMAIN_COLORS, NO_DOMAIN).alias("color"),
        by_value("type", BORDERS, 1).cast("long").alias("border"), F.when(F.col("type") == "AtomicConcept", "dot").otherwise("box").alias("shape"), tooltip.alias("tooltip"),
    )


def edge_style(edges: DataFrame) -> DataFrame:
    """(source, target, type, width, dashed, color, title)"""
    title = F.format_string("%s (%.2f)", F.col("type"), F.round("confidence", 2))
    return edges.select("source", "target", "type", F.greatest(F.lit(1.0), 4 * F.col("confidence")).alias("width"), F.col("cross_domain").alias("dashed"), by_value("type", EDGE_COLORS, NO_EDGE).alias("color"), title.alias("title"))
