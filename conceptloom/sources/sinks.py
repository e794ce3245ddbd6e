"""Writers of tables, documents, graphs and views, and reuse of what is already written."""

from __future__ import annotations

import hashlib
import html
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptloom.config import EngineConfig


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSONL files; readers see either the old or the new ones, as the committer renames when all tasks are done."""
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """One small file: written beside its place, then renamed over it, so that readers find the old one or the new one."""
    jvm = spark._jvm
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), spark._jsc.hadoopConfiguration())
    fs, _ = _fs(spark, path)
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(beside, jvm.org.apache.hadoop.fs.Path(path), over)


def write_document(spark: SparkSession, path: str, value: dict) -> None:
    """One small JSON document, replaced as a whole."""
    _replace(spark, path, json.dumps(value, ensure_ascii=False))


def stage_key(config: EngineConfig, *inputs: str) -> str:
    """What a stage's result depends on: its configuration and its inputs' names."""
    return hashlib.sha256(json.dumps([asdict(config), inputs], sort_keys=True).encode()).hexdigest()[:16]


def materialised(spark: SparkSession, path: str, make: Callable[[], DataFrame], key: str = "", force: bool = False) -> DataFrame:
    """The table under ``path`` for this key if it was written to the end, else it is made and written.

    The key (``stage_key`` of the configuration and the inputs) is part of the place, so what was made of another
    configuration or other inputs is never taken for it.
    """
    place = f"{path}/{key}" if key else path
    fs, done = _fs(spark, place + "/_SUCCESS")
    if force or not fs.exists(done):
        write_table(make(), place)
    return spark.read.parquet(place)


def append_pending(work: DataFrame, key: str, path: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Process only what is not yet in the table at ``path``, and append it: a crash loses nothing that was finished."""
    spark = work.sparkSession
    fs, there = _fs(spark, path)
    pending = work.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti") if fs.exists(there) else work
    make(pending).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _xml(c: str):
    return F.replace(F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """A GraphML document as part files in order: head, nodes, edges, foot; joined as text they are one document."""
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n<key id="t" for="all" attr.name="type" attr.type="string"/><key id="l" for="node" attr.name="label" attr.type="string"/><key id="c" for="edge" attr.name="confidence" attr.type="double"/>\n<graph edgedefault="directed">'
    spark = nodes.sparkSession
    line = lambda i, text: spark.createDataFrame([(i, text)], "part int, value string")
    n = nodes.select(F.lit(1).alias("part"), F.concat(F.lit('<node id="'), _xml("id"), F.lit('"><data key="t">'), _xml("type"), F.lit('</data><data key="l">'), _xml("label"), F.lit("</data></node>")).alias("value"))
    e = edges.select(F.lit(2).alias("part"), F.concat(F.lit('<edge source="'), _xml("source"), F.lit('" target="'), _xml("target"), F.lit('"><data key="t">'), _xml("type"), F.lit('</data><data key="c">'), _xml("confidence"), F.lit("</data></edge>")).alias("value"))
    rows = line(0, head).unionByName(n).unionByName(e).unionByName(line(3, "</graph>\n</graphml>"))
    rows.repartitionByRange("part").sortWithinPartitions("part").select("value").write.mode("overwrite").text(path)


# A page on its own: nodes on rings by type, edges as lines, tooltips on both.
_PAGE = """<!doctype html><meta charset=utf-8><title>%TITLE%</title><h1>%TITLE%</h1><svg id=v viewBox="-1100 -1100 2200 2200" style="width:100%;height:90vh"></svg>
<script>const g=%DATA%,ns="http://www.w3.org/2000/svg",v=document.getElementById("v"),kinds=[...new Set(g.nodes.map(n=>n.type))],at={};
function add(name,attrs,tip){const e=document.createElementNS(ns,name);for(const k in attrs)e.setAttribute(k,attrs[k]);const t=document.createElementNS(ns,"title");t.textContent=tip||"";e.appendChild(t);v.appendChild(e);return e}
kinds.forEach((k,i)=>{const own=g.nodes.filter(n=>n.type===k),r=kinds.length>1?120+850*i/(kinds.length-1):600;own.forEach((n,j)=>{const a=2*Math.PI*j/own.length+i;at[n.id]=[r*Math.cos(a),r*Math.sin(a)]})});
for(const e of g.edges){const s=at[e.source],t=at[e.target];if(s&&t)add("line",{x1:s[0],y1:s[1],x2:t[0],y2:t[1],stroke:e.color||"#999","stroke-width":e.width||1,"stroke-dasharray":e.dashed?"6 4":""},e.title||e.type)}
for(const n of g.nodes){const p=at[n.id];add("circle",{cx:p[0],cy:p[1],r:(n.size||12)/2,fill:n.color||"#69c"},n.tooltip||n.label||n.id);add("text",{x:p[0],y:p[1]-(n.size||12)/2-2,"font-size":12,"text-anchor":"middle"}).textContent=n.caption||n.label||n.id}
</script>"""


def write_view(nodes: DataFrame, edges: DataFrame, path: str, title: str, most: int = 2000) -> bool:
    """An HTML page that draws a view's nodes and edges; nothing is written, and False returned, for fewer than three nodes,
    or for more than ``most`` nodes or 20 times as many edges (a page can't show them, and none is left out silently).

    Columns of node_style (size, caption, color, tooltip) and edge_style (width, dashed, color, title) are used if they are there.
    """
    some = lambda df, names: df.select(*[c for c in names if c in df.columns])
    listed = some(nodes, ("id", "type", "label", "size", "caption", "color", "tooltip")).limit(most + 1).collect()
    links = some(edges, ("source", "target", "type", "width", "dashed", "color", "title")).limit(20 * most + 1).collect()
    if not 3 <= len(listed) <= most or len(links) > 20 * most:
        return False
    data = json.dumps({"nodes": [r.asDict() for r in listed], "edges": [r.asDict() for r in links]}, ensure_ascii=False).replace("</", "<\\/")
    _replace(nodes.sparkSession, path, _PAGE.replace("%TITLE%", html.escape(title)).replace("%DATA%", data))
    return True
