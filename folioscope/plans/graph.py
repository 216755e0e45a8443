"""Queries over the property graph: build, repair, checks, search, traversal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import ids, rules
from folioscope.functions.text import normalize_id
from folioscope.operators import graph as gr
from folioscope.runtime import table

KINDS = ("CALLS_API", "NEXT_STEP", "HAS_FIELD")
DISPLAY_TYPES = ("System", "Middleware", "Interface", "APIOperation", "DataEntity", "FlowNode", "BusinessRule", "Field")
TERMS = ("Order Hub", "warehouse", "stock feed", "元帳")


def _nodes(spark, sf_dir):
    return table(spark, sf_dir, "graph_nodes")


def _edges(spark, sf_dir):
    return table(spark, sf_dir, "graph_edges")


def graph_nodes_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert: the last state of every node that was not deleted."""
    n = gr.latest(_nodes(spark, sf_dir).drop("properties"), "node_id", ("created_at", "pos"))
    return n.filter("deleted_at is null").select("node_id", "pos", "name", "label", "confidence")


def graph_edges_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.latest(_edges(spark, sf_dir).drop("properties"), "id", ("loaded_at", "pos")).select("id", "pos", "relationship", "confidence")


def graph_nodes_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older merge: the first row of every id wins."""
    return gr.first_of(_nodes(spark, sf_dir).select("node_id", "pos", "name"), "node_id", "pos")


def graph_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of one canonical id merged."""
    n = _nodes(spark, sf_dir).filter("label is not null")
    key = ids.canonical_id(F.col("label"), F.col("name"), F.coalesce("project_id", F.lit("global")), F.col("workbook_name"), F.col("sheet_name"), mode="unicode")
    e = gr.merge_entities(n.withColumn("key", key), "key", fields=("name", "review_status", "layer"))
    return e.select("key", "pos", "confidence", "rows", "name", "review_status", "layer", F.size("aliases").alias("aliases"))


def graph_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of edges by the strategy that finds their node."""
    n, e = _nodes(spark, sf_dir), _edges(spark, sf_dir)
    refs = e.select("pos", F.explode(F.array("from_id", "to_id")).alias("ref")).filter("ref is not null")
    exact = n.select(F.col("node_id").alias("key")).distinct().withColumn("target", F.col("key"))
    lookups = [("exact", exact), ("normalised", gr.name_lookup(n, node="node_id", key=normalize_id(F.col("node_id")))), ("name", gr.name_lookup(n, node="node_id", key=F.col("name")))]
    loose = gr.resolve(refs, "ref", lookups[:1]).filter("target is null").select("pos", "ref")
    loose = gr.resolve(loose.withColumn("norm", normalize_id(F.col("ref"))), "norm", lookups[1:2]).select("strategy")
    found = gr.resolve(refs, "ref", lookups[:1]).filter("target is not null").select("strategy")
    return found.unionByName(loose).groupBy("strategy").agg(F.count("*").alias("ends"))


def graph_edge_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running ids of promoted edges."""
    e = _edges(spark, sf_dir).filter("review_status = 'verified'").select("pos", "project_id")
    n = gr.numbered(e, "pos")
    return n.select("pos", F.format_string("rel:%s:%06d", F.coalesce("project_id", F.lit("global")), "number").alias("edge_key"))


def graph_dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.dangling(_edges(spark, sf_dir).select("pos", "from_id", "to_id"), _nodes(spark, sf_dir)).select("pos")


def graph_connected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.connected(_edges(spark, sf_dir).select("pos", "from_id", "to_id"), _nodes(spark, sf_dir)).select("pos")


def graph_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _nodes(spark, sf_dir).filter("layer <> 'evidence'").select("node_id").distinct()
    return gr.isolated(n, _edges(spark, sf_dir))


def graph_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.repeated_keys(_nodes(spark, sf_dir), "node_id")


def graph_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, kept = gr.display_graph(_nodes(spark, sf_dir), _edges(spark, sf_dir), types=DISPLAY_TYPES, layers=("semantic",))
    return kept.select("pos")


def graph_confident_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges whose confidence, or that of their status, is at least 0.7."""
    sure = F.coalesce("confidence", F.when(F.col("review_status") == "verified", 1.0).when(F.col("review_status") == "rejected", 0.0).otherwise(0.5))
    return _edges(spark, sf_dir).filter(sure >= 0.7).select("pos", F.round(sure, 4).alias("sure"))


def graph_link_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link methods, corrected: only edges of a Mermaid node are explicit Mermaid edges."""
    n = _nodes(spark, sf_dir).select("node_id", (F.col("properties")["origin"] == "mermaid").alias("m")).groupBy("node_id").agg(F.max("m").alias("mermaid"))
    e = _edges(spark, sf_dir).select("pos", "from_id", "link_method").join(n, F.col("from_id") == F.col("node_id"), "left")
    fixed = F.when((F.col("link_method") == "explicit_mermaid_edge") & ~F.coalesce("mermaid", F.lit(False)), "structured_visual_edge").otherwise(F.col("link_method"))
    return e.groupBy(fixed.alias("method")).agg(F.count("*").alias("edges"))


def graph_name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = spark.createDataFrame([(t,) for t in TERMS], "term string")
    return gr.name_search(_nodes(spark, sf_dir).select("node_id", "name"), terms, term="term").groupBy("term", "node_id").agg(F.min("name").alias("name"))


def graph_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference entries that a chunk's content names."""
    c, r = table(spark, sf_dir, "chunks"), table(spark, sf_dir, "ref_entities")
    return gr.contains_join(c, r, text_key="pos", text="content", name_key="ref_id", name="name")


def _seeds(spark, sf_dir):
    return _nodes(spark, sf_dir).filter("label = 'System'").select("node_id").distinct()


def graph_hop1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.expand_one(_seeds(spark, sf_dir), _edges(spark, sf_dir), seed="node_id", kinds=KINDS)


def graph_hop2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.expand_two(_seeds(spark, sf_dir), _edges(spark, sf_dir), seed="node_id", kinds=KINDS)


def graph_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walks of up to three steps from the seeds, counted by length."""
    seeds = _seeds(spark, sf_dir)
    w = gr.walks(seeds, _edges(spark, sf_dir).filter("relationship = 'NEXT_STEP'"), seed="node_id", depth=3)
    return w.groupBy("seed", "length").agg(F.count("*").alias("walks"), F.count_distinct("found").alias("ends"))


def graph_reachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.reachable(_seeds(spark, sf_dir), _edges(spark, sf_dir).filter("relationship = 'NEXT_STEP'"), seed="node_id").select("seed", "found", "steps")


def graph_review_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow nodes without a next step, operations that nothing calls, and unsure pending nodes."""
    n, e = _nodes(spark, sf_dir), _edges(spark, sf_dir)
    next_, calls = e.filter("relationship = 'NEXT_STEP'").select("from_id"), e.filter("relationship = 'CALLS_API'").select("to_id")
    a = n.filter("label = 'FlowNode'").join(next_, F.col("node_id") == F.col("from_id"), "left_anti").select("pos", F.lit("no_next_step").alias("task"))
    b = n.filter("label = 'APIOperation'").join(calls, F.col("node_id") == F.col("to_id"), "left_anti").select("pos", F.lit("no_caller").alias("task"))
    c = n.filter("review_status = 'pending' and confidence < 0.7").select("pos", F.lit("unsure").alias("task"))
    return a.unionByName(b).unionByName(c)


def graph_sheet_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance: objects extracted from each sheet that has a node."""
    n = _nodes(spark, sf_dir).filter("workbook_name is not null and sheet_name is not null and project_id is not null")
    sheets = n.filter("label = 'Sheet'").groupBy("project_id", "workbook_name", "sheet_name").agg(F.min("node_id").alias("sheet_id"))
    return n.filter("label <> 'Sheet'").select("project_id", "workbook_name", "sheet_name", "node_id").distinct().join(sheets, ["project_id", "workbook_name", "sheet_name"]).select("sheet_id", "node_id")


def graph_cross_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Isolation: edges between nodes of different projects, counted by project."""
    n = _nodes(spark, sf_dir).filter("project_id is not null").groupBy("node_id").agg(F.min("project_id").alias("p"))
    e = _edges(spark, sf_dir).select("pos", "from_id", "to_id")
    a, b = n.select(F.col("node_id").alias("from_id"), F.col("p").alias("from_project")), n.select(F.col("node_id").alias("to_id"), F.col("p").alias("to_project"))
    return e.join(a, "from_id").join(b, "to_id").filter("from_project <> to_project").groupBy("from_project").agg(F.count("*").alias("edges"))


def graph_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    by = lambda s: F.count_if(F.col("review_status") == s).alias(s)
    return e.groupBy("relationship").agg(F.count("*").alias("edges"), by("verified"), by("pending"), by("rejected"), F.count_if(F.col("review_status").isNull()).alias("no_status"), F.round(F.avg("confidence"), 4).alias("confidence"))


def graph_type_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which labels are linked by which relationship."""
    n = _nodes(spark, sf_dir).filter("label is not null").groupBy("node_id").agg(F.min("label").alias("label"))
    a, b = n.select(F.col("node_id").alias("from_id"), F.col("label").alias("from_label")), n.select(F.col("node_id").alias("to_id"), F.col("label").alias("to_label"))
    return _edges(spark, sf_dir).join(a, "from_id").join(b, "to_id").groupBy("from_label", "relationship", "to_label").agg(F.count("*").alias("edges"))


def graph_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate before a load: one row of measures, and what they say."""
    n, e = _nodes(spark, sf_dir), _edges(spark, sf_dir)
    nodes = n.agg(F.count("*").alias("nodes"), F.count_distinct("node_id").alias("node_ids"), F.count_if(F.col("confidence") < 0.5).alias("unsure"))
    edges = e.agg(F.count("*").alias("edges"), F.count_distinct("relationship").alias("kinds"), F.count_if(F.col("confidence").isNull()).alias("no_confidence"))
    loose = graph_dangling(spark, sf_dir).agg(F.count("*").alias("dangling"))
    alone = graph_isolated(spark, sf_dir).agg(F.count("*").alias("isolated"))
    m = nodes.crossJoin(edges).crossJoin(loose).crossJoin(alone)  # four tables of one row
    grade = rules.first_match([(F.col("nodes") > F.col("node_ids"), F.lit("P0")), (F.col("dangling") > 0.2 * F.col("edges"), F.lit("P0")), (F.col("isolated") > 0.3 * F.col("node_ids"), F.lit("P1")), (F.col("unsure") > 0.5 * F.col("nodes"), F.lit("P2"))], F.lit("pass"))
    return m.withColumn("grade", grade)


def graph_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.node_statements(_nodes(spark, sf_dir)).unionByName(gr.edge_statements(gr.connected(_edges(spark, sf_dir), _nodes(spark, sf_dir))))


def graph_project_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by project and label, with subtotals."""
    return _nodes(spark, sf_dir).rollup("project_id", "label").agg(F.count("*").alias("nodes"), F.grouping_id().alias("level"))


_NORM = "coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({0}, ''))), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), ''), 'unknown')"
_UNI = r"coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(coalesce({0}, ''), '^[\s　\x{{a0}}]+|[\s　\x{{a0}}]+$', '', 'g')), '[^\p{{L}}\p{{N}}_]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), ''), 'unknown')"
_PREFIX = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ids.TYPE_PREFIX.items()) + " ELSE substr(lower(label), 1, 20) END"
_SHEETS, _GLOBALS = ("(" + ", ".join(f"'{x}'" for x in t) + ")" for t in (ids.STEP_TYPES + ids.SHEET_TYPES, ids.GLOBAL_TYPES))
_BEST = "arg_max({0}, (coalesce(confidence, 0), -pos)) FILTER ({0} IS NOT NULL AND {0} <> '')"
_ESC = r"replace(regexp_replace(replace(replace(substr(coalesce({0}, ''), 1, 500), '\', '\\'), '''', '\'''), '\r\n|[\r\n]', ' ', 'g'), ';', '；')"
_SET = r"CASE WHEN regexp_replace(coalesce({0}, ''), '[\s　\x{{a0}}]+', '', 'g') <> '' THEN 'n.{0} = ''' || " + _ESC + " || '''' END"
_KIND = "regexp_replace({0}, '[^A-Za-z0-9_]', '_', 'g')"
_IN = "(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
_SEEDS = "s AS (SELECT DISTINCT node_id AS a FROM graph_nodes WHERE label = 'System')"
_WAYS = f"w AS (SELECT DISTINCT a, b, edge, kind FROM (SELECT from_id AS a, to_id AS b, id AS edge, relationship AS kind FROM graph_edges UNION ALL SELECT to_id, from_id, id, relationship FROM graph_edges) WHERE a IS NOT NULL AND b IS NOT NULL AND kind IN {_IN})"
_DANGLING = "SELECT pos FROM graph_edges WHERE NOT coalesce(from_id IN (SELECT node_id FROM graph_nodes), false) OR NOT coalesce(to_id IN (SELECT node_id FROM graph_nodes), false)"
_ISOLATED = "SELECT DISTINCT node_id FROM graph_nodes n WHERE layer <> 'evidence' AND NOT EXISTS (SELECT 1 FROM graph_edges e WHERE e.from_id = n.node_id OR e.to_id = n.node_id)"
_TYPES = "(" + ", ".join(f"'{t}'" for t in DISPLAY_TYPES) + ")"

QUERIES = {
    f.__name__: f
    for f in (
        graph_nodes_current, graph_edges_current, graph_nodes_first, graph_entities, graph_resolved, graph_edge_numbers, graph_dangling, graph_connected, graph_isolated,
        graph_repeated_ids, graph_display, graph_confident_edges, graph_link_methods, graph_name_search, graph_mentions, graph_hop1, graph_hop2, graph_walks, graph_reachable,
        graph_review_tasks, graph_sheet_objects, graph_cross_project, graph_types, graph_type_matrix, graph_gate, graph_statements, graph_project_rollup,
    )
}
SQL = {
    "graph_nodes_current": "SELECT node_id, pos, name, label, confidence FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY created_at DESC, pos DESC) AS r FROM graph_nodes) WHERE r = 1 AND deleted_at IS NULL",
    "graph_edges_current": "SELECT id, pos, relationship, confidence FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, pos DESC) AS r FROM graph_edges) WHERE r = 1",
    "graph_nodes_first": "SELECT node_id, pos, name FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY pos) AS r FROM graph_nodes) WHERE r = 1",
    "graph_entities": f"""WITH n AS (SELECT *, {_PREFIX} AS prefix, coalesce(project_id, 'global') AS p, substr({_UNI.format("name")}, 1, 50) AS k,
          {_UNI.format("workbook_name")} AS b, {_UNI.format("sheet_name")} AS s FROM graph_nodes WHERE label IS NOT NULL),
        c AS (SELECT *, CASE WHEN label IN {_SHEETS} THEN prefix || ':' || p || ':' || b || ':' || s || ':' || k WHEN label IN {_GLOBALS} THEN prefix || ':' || p || ':' || k
          ELSE prefix || ':' || p || ':' || b || ':' || k END AS key FROM n)
        SELECT key, min(pos) AS pos, max(confidence) AS confidence, count(*) AS rows, {_BEST.format("name")} AS name, {_BEST.format("review_status")} AS review_status,
          {_BEST.format("layer")} AS layer, greatest(0, count(DISTINCT name) FILTER (name <> '') - 1)::int AS aliases FROM c GROUP BY key""",
    "graph_statements": f"""SELECT 'MERGE (n:' || {_KIND.format("coalesce(label, 'Entity')")} || ' {{id: ''' || {_ESC.format("node_id")} || '''}})' ||
          CASE WHEN concat_ws(', ', {_SET.format("name")}, {_SET.format("project_id")}) <> '' THEN ' SET ' || concat_ws(', ', {_SET.format("name")}, {_SET.format("project_id")}) ELSE '' END || ';' AS statement FROM graph_nodes
        UNION ALL SELECT 'MATCH (a {{id: ''' || {_ESC.format("from_id")} || '''}}), (b {{id: ''' || {_ESC.format("to_id")} || '''}}) MERGE (a)-[r:' || {_KIND.format("relationship")} || ' {{id: ''' || {_ESC.format("id")} || '''}}]->(b);'
          FROM graph_edges WHERE from_id IN (SELECT node_id FROM graph_nodes) AND to_id IN (SELECT node_id FROM graph_nodes)""",
    "graph_edge_numbers": "SELECT pos, 'rel:' || coalesce(project_id, 'global') || ':' || lpad((row_number() OVER (ORDER BY pos))::varchar, 6, '0') AS edge_key FROM graph_edges WHERE review_status = 'verified'",
    "graph_dangling": _DANGLING,
    "graph_connected": "SELECT pos FROM graph_edges WHERE from_id IN (SELECT node_id FROM graph_nodes) AND to_id IN (SELECT node_id FROM graph_nodes)",
    "graph_isolated": _ISOLATED,
    "graph_repeated_ids": "SELECT node_id, count(*) AS rows FROM graph_nodes GROUP BY 1 HAVING count(*) > 1",
    "graph_display": f"""WITH n AS (SELECT node_id FROM graph_nodes WHERE label IN {_TYPES} AND coalesce(layer, 'semantic') = 'semantic')
        SELECT pos FROM graph_edges WHERE coalesce(review_status, 'verified') <> 'rejected' AND from_id IN (FROM n) AND to_id IN (FROM n)""",
    "graph_confident_edges": "WITH e AS (SELECT pos, coalesce(confidence, CASE review_status WHEN 'verified' THEN 1.0 WHEN 'rejected' THEN 0.0 ELSE 0.5 END) AS s FROM graph_edges) SELECT pos, round(s, 4) AS sure FROM e WHERE s >= 0.7",
    "graph_link_methods": """WITH n AS (SELECT node_id, max(properties['origin'] = 'mermaid') AS m FROM graph_nodes GROUP BY 1)
        SELECT CASE WHEN link_method = 'explicit_mermaid_edge' AND NOT coalesce(m, false) THEN 'structured_visual_edge' ELSE link_method END AS method, count(*) AS edges
        FROM graph_edges e LEFT JOIN n ON e.from_id = n.node_id GROUP BY 1""",
    "graph_mentions": r"SELECT DISTINCT c.pos, r.ref_id FROM chunks c JOIN ref_entities r ON contains(lower(c.content), lower(r.name))",
    "graph_name_search": f"""WITH t AS (SELECT unnest([{", ".join(f"'{t}'" for t in TERMS)}]) AS term), h AS (SELECT DISTINCT term, node_id, name FROM t JOIN graph_nodes ON contains(lower(name), lower(term))),
        r AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY node_id, name) AS n FROM h) SELECT term, node_id, min(name) AS name FROM r WHERE n <= 10 GROUP BY 1, 2""",
    "graph_reachable": f"""WITH RECURSIVE {_SEEDS}, e AS (SELECT DISTINCT from_id, to_id FROM graph_edges WHERE relationship = 'NEXT_STEP'),
        p AS (SELECT a AS seed, a AS found, 0 AS steps FROM s UNION SELECT p.seed, e.to_id, p.steps + 1 FROM p JOIN e ON e.from_id = p.found WHERE p.steps < 30)
        SELECT seed, found, min(steps) AS steps FROM p WHERE found <> seed GROUP BY 1, 2""",
    "graph_resolved": f"""WITH r AS (SELECT unnest([from_id, to_id]) AS ref FROM graph_edges), x AS (SELECT ref, ref IN (SELECT node_id FROM graph_nodes) AS exact FROM r WHERE ref IS NOT NULL),
        n AS (SELECT {_NORM.format("node_id")} AS k, min(node_id) AS a, max(node_id) AS b FROM graph_nodes GROUP BY 1)
        SELECT CASE WHEN exact THEN 'exact' WHEN {_NORM.format("ref")} IN (SELECT k FROM n WHERE a = b AND k <> '') THEN 'normalised' ELSE 'unresolved' END AS strategy, count(*) AS ends FROM x GROUP BY 1""",
    "graph_hop1": f"""WITH {_SEEDS}, {_WAYS}, h AS (SELECT DISTINCT a AS seed, b AS found, kind, edge FROM s JOIN w USING (a)),
        r AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY found, edge) AS n FROM h) SELECT seed, found, kind, edge, 0.6 AS score FROM r WHERE n <= 10""",
    "graph_hop2": f"""WITH {_SEEDS}, {_WAYS}, h AS (SELECT DISTINCT s.a AS seed, y.b AS found, x.kind || '/' || y.kind AS path, x.edge || '/' || y.edge AS edges
          FROM s JOIN w x ON x.a = s.a JOIN w y ON y.a = x.b WHERE x.edge <> y.edge AND y.b <> s.a),
        r AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY found, edges) AS n FROM h) SELECT seed, found, path, edges, 0.5 AS score FROM r WHERE n <= 5""",
    "graph_walks": f"""WITH RECURSIVE {_SEEDS}, e AS (SELECT DISTINCT from_id, to_id, id FROM graph_edges WHERE relationship = 'NEXT_STEP' AND from_id IS NOT NULL AND to_id IS NOT NULL),
        p AS (SELECT a AS seed, e.to_id AS found, 1 AS length, [e.id] AS walked FROM s JOIN e ON e.from_id = s.a
          UNION ALL SELECT p.seed, e.to_id, p.length + 1, list_append(p.walked, e.id) FROM p JOIN e ON e.from_id = p.found WHERE p.length < 3 AND NOT list_contains(p.walked, e.id))
        SELECT seed, length, count(*) AS walks, count(DISTINCT found) AS ends FROM p GROUP BY 1, 2""",
    "graph_review_tasks": """SELECT pos, 'no_next_step' AS task FROM graph_nodes WHERE label = 'FlowNode' AND node_id NOT IN (SELECT from_id FROM graph_edges WHERE relationship = 'NEXT_STEP' AND from_id IS NOT NULL)
        UNION ALL SELECT pos, 'no_caller' FROM graph_nodes WHERE label = 'APIOperation' AND node_id NOT IN (SELECT to_id FROM graph_edges WHERE relationship = 'CALLS_API' AND to_id IS NOT NULL)
        UNION ALL SELECT pos, 'unsure' FROM graph_nodes WHERE review_status = 'pending' AND confidence < 0.7""",
    "graph_sheet_objects": """WITH n AS (SELECT * FROM graph_nodes WHERE workbook_name IS NOT NULL AND sheet_name IS NOT NULL AND project_id IS NOT NULL),
        s AS (SELECT project_id, workbook_name, sheet_name, min(node_id) AS sheet_id FROM n WHERE label = 'Sheet' GROUP BY 1, 2, 3)
        SELECT DISTINCT s.sheet_id, n.node_id FROM n JOIN s USING (project_id, workbook_name, sheet_name) WHERE n.label <> 'Sheet'""",
    "graph_cross_project": """WITH n AS (SELECT node_id, min(project_id) AS p FROM graph_nodes WHERE project_id IS NOT NULL GROUP BY 1)
        SELECT a.p AS from_project, count(*) AS edges FROM graph_edges e JOIN n a ON a.node_id = e.from_id JOIN n b ON b.node_id = e.to_id WHERE a.p <> b.p GROUP BY 1""",
    "graph_types": """SELECT relationship, count(*) AS edges, count_if(review_status = 'verified') AS verified, count_if(review_status = 'pending') AS pending,
        count_if(review_status = 'rejected') AS rejected, count_if(review_status IS NULL) AS no_status, round(avg(confidence), 4) AS confidence FROM graph_edges GROUP BY 1""",
    "graph_type_matrix": """WITH n AS (SELECT node_id, min(label) AS label FROM graph_nodes WHERE label IS NOT NULL GROUP BY 1)
        SELECT a.label AS from_label, relationship, b.label AS to_label, count(*) AS edges FROM graph_edges e JOIN n a ON a.node_id = e.from_id JOIN n b ON b.node_id = e.to_id GROUP BY 1, 2, 3""",
    "graph_gate": f"""WITH m AS (SELECT (SELECT count(*) FROM graph_nodes) AS nodes, (SELECT count(DISTINCT node_id) FROM graph_nodes) AS node_ids, (SELECT count_if(confidence < 0.5) FROM graph_nodes) AS unsure,
          (SELECT count(*) FROM graph_edges) AS edges, (SELECT count(DISTINCT relationship) FROM graph_edges) AS kinds, (SELECT count_if(confidence IS NULL) FROM graph_edges) AS no_confidence,
          (SELECT count(*) FROM ({_DANGLING})) AS dangling, (SELECT count(*) FROM ({_ISOLATED})) AS isolated)
        SELECT *, CASE WHEN nodes > node_ids THEN 'P0' WHEN dangling > 0.2 * edges THEN 'P0' WHEN isolated > 0.3 * node_ids THEN 'P1' WHEN unsure > 0.5 * nodes THEN 'P2' ELSE 'pass' END AS grade FROM m""",
    "graph_project_rollup": "SELECT project_id, label, count(*) AS nodes, grouping(project_id, label)::bigint AS level FROM graph_nodes GROUP BY ROLLUP (project_id, label)",
}
