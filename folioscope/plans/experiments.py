"""Queries that compare runs: splitters and sizes, sheets near a search, edges with their ends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import chunking as ch
from folioscope.operators import graph as gr
from folioscope.operators import stats
from folioscope.runtime import table

#: The sweep: (name, splitter, most, least, target characters).
SWEEP = (("fixed_2000", "fixed", 2000, 100, 2000), ("fixed_3200", "fixed", 3200, 200, 3200), ("semantic_4000", "semantic", 4000, 100, 2000), ("semantic_4000_200", "semantic", 4000, 200, 2000))


def experiment_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all documents under every splitter and size of the sweep."""
    d = table(spark, sf_dir, "documents").filter("text is not null")
    runs = [ch.chunk_documents(d.withColumn("strategy", F.lit(s)), key="doc_id", body="text", strategy="strategy", most=m, least=lo, target=t).select(F.lit(n).alias("run"), F.length("content").alias("chars"), "content") for n, s, m, lo, t in SWEEP]
    return stats.length_stats(reduce(DataFrame.unionByName, runs), ["run"], "chars", tables=F.col("content").contains("|---"))


def graph_sheets_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets one edge from nodes that a term names, else two edges."""
    n, e = table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges")
    terms = spark.createDataFrame([("Order Hub",), ("stock",)], "term string")
    seeds = gr.name_search(n.select("node_id", "name"), terms, term="term", per_term=None).select(F.col("node_id").alias("a")).distinct()
    ways = gr.both_ways(e).select("a", "b").distinct()
    sheets = n.filter("label = 'Sheet'").select(F.col("node_id").alias("b")).distinct()
    one = seeds.join(ways, "a")
    near = one.join(sheets, "b", "left_semi").select(F.col("b").alias("sheet"), F.lit(1).alias("steps"))
    two = one.select(F.col("b").alias("a")).distinct().join(ways, "a").join(sheets, "b", "left_semi").select(F.col("b").alias("sheet"), F.lit(2).alias("steps"))
    return near.unionByName(two).groupBy("sheet").agg(F.min("steps").alias("steps"))


def graph_edge_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with label and name of both ends; where a node is missing, its id tells what it can."""
    n = table(spark, sf_dir, "graph_nodes").groupBy("node_id").agg(F.max_by(F.struct("label", "name"), F.struct("created_at", "pos")).alias("r"))
    a = n.select(F.col("node_id").alias("from_id"), F.col("r.label").alias("from_label"), F.col("r.name").alias("from_name"))
    b = n.select(F.col("node_id").alias("to_id"), F.col("r.label").alias("to_label"), F.col("r.name").alias("to_name"))
    e = table(spark, sf_dir, "graph_edges").select("pos", "from_id", "to_id", "relationship").join(a, "from_id", "left").join(b, "to_id", "left")
    last = lambda c: F.element_at(F.split(c, ":"), -1)
    end = lambda s: F.coalesce(F.nullif(F.col(f"{s}_name"), F.lit("")), last(F.col(f"{s}_id")))
    return e.select("pos", "relationship", F.coalesce("from_label", F.lit("?")).alias("from_label"), end("from").alias("from_end"), F.coalesce("to_label", F.lit("?")).alias("to_label"), end("to").alias("to_end"))


def graph_optional_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed chain with an optional last link: operation, what it calls, and the fields of that, if any."""
    n, e = table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges").filter("from_id is not null and to_id is not null")
    ops = n.filter("label = 'FlowNode'").select(F.col("node_id").alias("flow")).distinct()
    calls = e.filter("relationship = 'CALLS_API'").select(F.col("from_id").alias("flow"), F.col("to_id").alias("called")).distinct()
    fields = e.filter("relationship in ('HAS_FIELD', 'HAS_CONDITION')").groupBy(F.col("from_id").alias("called")).agg(F.count_distinct("to_id").alias("fields"))
    return ops.join(calls, "flow").join(fields, "called", "left").select("flow", "called", F.coalesce("fields", F.lit(0)).alias("fields"))


QUERIES = {f.__name__: f for f in (experiment_sweep, graph_sheets_near, graph_edge_ends, graph_optional_chain)}
SQL = {
    "graph_sheets_near": """WITH h AS (SELECT DISTINCT t.term, node_id, name FROM (SELECT unnest(['Order Hub', 'stock']) AS term) t JOIN graph_nodes ON contains(lower(name), lower(t.term))),
        s AS (SELECT DISTINCT node_id AS a FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY node_id, name) AS n FROM h) WHERE n <= 50),
        w AS (SELECT DISTINCT a, b FROM (SELECT from_id AS a, to_id AS b FROM graph_edges UNION ALL SELECT to_id, from_id FROM graph_edges) WHERE a IS NOT NULL AND b IS NOT NULL),
        x AS (SELECT w.b, 1 AS steps FROM s JOIN w USING (a) UNION ALL SELECT v.b, 2 FROM s JOIN w USING (a) JOIN w v ON v.a = w.b)
        SELECT b AS sheet, min(steps) AS steps FROM x WHERE b IN (SELECT node_id FROM graph_nodes WHERE label = 'Sheet') GROUP BY 1""",
    "graph_edge_ends": """WITH n AS (SELECT node_id, label, name FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY created_at DESC, pos DESC) AS r FROM graph_nodes) WHERE r = 1)
        SELECT e.pos, relationship, coalesce(a.label, '?') AS from_label, coalesce(nullif(a.name, ''), list_last(string_split(e.from_id, ':'))) AS from_end,
          coalesce(b.label, '?') AS to_label, coalesce(nullif(b.name, ''), list_last(string_split(e.to_id, ':'))) AS to_end
        FROM graph_edges e LEFT JOIN n a ON a.node_id = e.from_id LEFT JOIN n b ON b.node_id = e.to_id""",
    "graph_optional_chain": """WITH o AS (SELECT DISTINCT node_id FROM graph_nodes WHERE label = 'FlowNode'), c AS (SELECT DISTINCT from_id, to_id FROM graph_edges WHERE relationship = 'CALLS_API' AND from_id IS NOT NULL AND to_id IS NOT NULL),
        f AS (SELECT from_id, count(DISTINCT to_id) AS n FROM graph_edges WHERE relationship IN ('HAS_FIELD', 'HAS_CONDITION') AND from_id IS NOT NULL AND to_id IS NOT NULL GROUP BY 1)
        SELECT c.from_id AS flow, c.to_id AS called, coalesce(f.n, 0) AS fields FROM o JOIN c ON c.from_id = o.node_id LEFT JOIN f ON f.from_id = c.to_id""",
}
