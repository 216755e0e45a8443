"""Queries of extraction and linking: entities, keyword graph, named links, layers, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import layout
from folioscope.operators import extraction, linking
from folioscope.operators.retrieval import best_entities
from folioscope.runtime import table


def entity_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of all node names, by pattern."""
    n = table(spark, sf_dir, "graph_nodes").filter("name is not null")
    return extraction.entities(n, key="pos", text="name", source="query").groupBy("type", "confidence").agg(F.count("*").alias("found"), F.count_distinct("text").alias("texts"))


def entity_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that differ in case only: the surest row, at a tie the first."""
    n = table(spark, sf_dir, "graph_nodes").filter("name is not null and confidence is not null").select(F.col("name").alias("text"), "confidence", F.col("pos").alias("place"))
    return best_entities(n).select(F.lower("text").alias("name"), "confidence", "place")


def graph_keyword_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks")
    _, edges = extraction.keyword_graph(c, sheet=F.col("document_id"))
    return edges.groupBy("project_id").agg(F.count("*").alias("edges"), F.count_distinct("to_id").alias("systems"))


def graph_named_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of rules that name an API of the reference list: new CALLS_API candidates."""
    c = table(spark, sf_dir, "chunks").filter("content is not null and chunk_type = 'business_rule'").select(F.col("chunk_id").alias("node_id"), F.col("content").alias("description")).distinct()
    r = table(spark, sf_dir, "ref_entities").filter("label = 'APIOperation'").select(F.col("ref_id").cast("string").alias("node_id"), "name")
    return linking.named_links(c, r, table(spark, sf_dir, "graph_edges"), kind="CALLS_API").select("from_id", "to_id", "confidence")


def graph_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, _ = linking.layered_context(table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges"))
    return nodes


def graph_layer_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, edges = linking.layered_context(table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges"))
    return edges


def link_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks").filter("project_id is not null")
    d = c.filter("source_type = 'mermaid'").select("project_id", F.regexp_extract("source_file", r"([^/]+)\.[^.]+$", 1).alias("diagram"), "source_file", F.col("chunk_index").alias("place"), "content")
    b = c.filter("workbook_name <> ''").select(F.col("pos").alias("key"), "project_id", F.col("workbook_name").alias("book"), "content")
    return linking.diagram_links(d, b, linking.shared_labels(linking.diagram_labels(d), b))


def snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("chunks", "graph_nodes", "graph_edges")
    return linking.snapshot({n: table(spark, sf_dir, n) for n in names}).select(F.col("table").alias("source"), "key", "rows")


def layout_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of pages as large as the parts' sizes and prices say (a stand-in for rendered pages)."""
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 200).cast("int").alias("w"), (F.col("p_retailprice") * 4).cast("int").alias("h"))
    return p.select("p_partkey", F.inline(layout.tiles(F.col("w"), F.col("h"))))


_LAYERS = {"business": linking.BUSINESS, "implementation": linking.IMPLEMENTATION}


def _layer(name: str) -> str:
    labels = ", ".join(f"'{x}'" for x in _LAYERS[name])
    return f"SELECT '{name}' AS layer, node_id, max(confidence) AS confidence FROM graph_nodes WHERE label IN ({labels}) GROUP BY 2 ORDER BY confidence DESC NULLS LAST, node_id LIMIT 60"


QUERIES = {f.__name__: f for f in (entity_patterns, entity_best, graph_keyword_edges, graph_named_links, graph_layers, graph_layer_edges, link_diagrams, snapshot_counts, layout_tiles)}
SQL = {
    "entity_best": "SELECT lower(name) AS name, max(confidence) AS confidence, arg_min(pos, (-confidence, pos)) AS place FROM graph_nodes WHERE name IS NOT NULL AND confidence IS NOT NULL GROUP BY 1",
    "graph_named_links": """SELECT DISTINCT c.chunk_id AS from_id, r.ref_id::varchar AS to_id, 0.7 AS confidence FROM chunks c JOIN ref_entities r
        ON contains(lower(c.content), lower(r.name)) WHERE c.chunk_type = 'business_rule' AND r.label = 'APIOperation'""",
    "graph_layers": f"(FROM ({_layer('business')})) UNION ALL (FROM ({_layer('implementation')}))",
    "graph_layer_edges": f"""WITH b AS ({_layer("business")}), i AS ({_layer("implementation")})
        (SELECT 'business' AS layer, pos, relationship FROM graph_edges WHERE from_id IN (SELECT node_id FROM b) AND to_id IN (SELECT node_id FROM b) ORDER BY confidence DESC NULLS LAST, pos LIMIT 80)
        UNION ALL (SELECT 'implementation', pos, relationship FROM graph_edges WHERE from_id IN (SELECT node_id FROM i) AND to_id IN (SELECT node_id FROM i) ORDER BY confidence DESC NULLS LAST, pos LIMIT 80)""",
    "snapshot_counts": "SELECT 'chunks' AS source, coalesce(project_id, '') AS key, count(*) AS rows FROM chunks GROUP BY 2 UNION ALL SELECT 'graph_nodes', coalesce(project_id, ''), count(*) FROM graph_nodes GROUP BY 2 UNION ALL SELECT 'graph_edges', coalesce(project_id, ''), count(*) FROM graph_edges GROUP BY 2",
    "layout_tiles": """WITH p AS (SELECT p_partkey, (p_size * 200)::int AS w, floor(p_retailprice * 4)::int AS h FROM part),
        r AS (SELECT *, unnest(range(0, greatest(1, h), 2700)) AS top FROM p), c AS (SELECT *, unnest(range(0, greatest(1, w), 2700)) AS l FROM r)
        SELECT p_partkey, printf('tile_r%02d_c%02d', top // 2700, l // 2700) AS name, l::int AS left, top::int AS top, least(l + 3000, w)::int AS right, least(top + 3000, h)::int AS bottom FROM c""",
    "graph_keyword_edges": """WITH e AS (SELECT DISTINCT project_id, lower(document_id) AS d, unnest(systems) AS s FROM chunks WHERE project_id IS NOT NULL)
        SELECT project_id, count(DISTINCT d || '|' || lower(s)) AS edges, count(DISTINCT lower(s)) AS systems FROM e WHERE s <> '' GROUP BY 1""",
}
