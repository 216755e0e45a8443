"""One query through all stages: intent, vector and word search, fusion, boost, graph expansion, rerank."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import models, rules
from folioscope.functions import text as tx
from folioscope.operators import graph as gr
from folioscope.operators import retrieval as rt

# The relationships that an intent follows, and the intents that go two steps.
ALLOWED = {
    "api": ("CALLS_API", "HAS_PARAMETER", "NEXT_STEP", "EXTRACTED_OBJECT", "HAS_SHEET", "CONTAINS_STEP"),
    "mapping": ("EXTRACTED_OBJECT", "HAS_SOURCE_FIELD", "HAS_TARGET_FIELD", "HAS_FIELD", "HAS_MAPPING_ROW", "HAS_SHEET", "USES_FIELD"),
    "flowchart": ("NEXT_STEP", "BRANCHES_TO", "CALLS_API", "CONTAINS_STEP", "EXTRACTED_OBJECT", "HAS_SHEET", "APPLIES_RULE"),
    "field": ("HAS_FIELD", "HAS_SOURCE_FIELD", "HAS_TARGET_FIELD", "USES_FIELD", "EXTRACTED_OBJECT", "HAS_SHEET"),
    "rule": ("APPLIES_RULE", "BRANCHES_TO", "HAS_CONDITION", "EXTRACTED_OBJECT", "HAS_SHEET", "NEXT_STEP"),
    "overview": ("HAS_SHEET", "EXTRACTED_OBJECT", "HAS_PROCESS", "USES_SYSTEM"),
}
TWO_STEPS = ("mapping", "flowchart", "api")


@dataclass
class Trace:
    """What each stage did, for the answer's record."""

    intent: str = ""
    confidence: float = 0.0
    words: list[str] = field(default_factory=list)
    stages: list[str] = field(default_factory=list)


class Retriever:
    """Search over chunks (chunk_id, content, embedding, project_id, workbook_name, sheet_name) and a graph.

    The result is a lazily composed DataFrame: chunk_id, score, source, content. Every table is filtered by
    project first, so no row of another project can come out.
    """

    def __init__(self, spark: SparkSession, chunks: DataFrame, nodes: DataFrame | None = None, edges: DataFrame | None = None, *, embed=None):
        self.spark, self.chunks, self.nodes, self.edges = spark, chunks, nodes, edges
        self.embed = embed or models.hashed_embedding()

    def retrieve(self, query: str, *, project: str | None = None, k: int = 5, graph: bool = False, rerank: bool = False) -> tuple[DataFrame, Trace]:
        import unicodedata

        query = " ".join(unicodedata.normalize("NFKC", query).split())
        q = F.lit(query)
        row = self.spark.range(1).select(rules.query_intent(q).alias("i"), tx.search_keywords(q).alias("words"), tx.boost_keywords(q).alias("boost"), tx.guidance_terms(q).alias("terms")).first()
        trace = Trace(row.i.label, row.i.confidence, list(row.words))
        rows = self.chunks if project is None else self.chunks.filter(F.col("project_id") == project)
        vector = rt.nearest_keys(rows, self.embed([query])[0], 2 * k, key="chunk_id", once=True).select("chunk_id", "score")
        words = rt.keyword_search(rows.select("chunk_id", "content"), row.words, 2 * k, key="chunk_id", text="content", once=True)
        hits = rt.fuse(vector, words, key="chunk_id", k=2 * k)
        trace.stages += ["vector", "words", "fuse"]
        if graph and self.nodes is not None and row.terms:
            hits = hits.select("chunk_id", "score", "source").unionByName(self._from_graph(rows, row.terms, trace, project).join(hits.select("chunk_id"), "chunk_id", "left_anti"))
            trace.stages.append("graph")
        copies = hits.select("chunk_id", "score", "source").join(rows.select("chunk_id", "content"), "chunk_id")
        found = copies.groupBy("chunk_id", "score", "source").agg(F.max("content").alias("content"))
        if row.boost:
            found = rt.keyword_boost(found, list(row.boost), text="content")
            trace.stages.append("boost")
        if rerank:
            trace.stages.append("rerank")
            return rt.rerank(found, rt.lexical_model(query), key="chunk_id", text="content", k=k), trace
        return rt.top_k(found, k, "score", "chunk_id"), trace

    def _from_graph(self, rows: DataFrame, terms: list[str], trace: Trace, project: str | None) -> DataFrame:
        nodes = self.nodes if project is None else self.nodes.filter((F.col("project_id") == project) | F.col("project_id").isNull())
        t = self.spark.createDataFrame([(x,) for x in terms], "term string")
        seeds = gr.name_search(nodes.select("node_id", "name"), t, term="term").select("node_id").distinct()
        kinds = ALLOWED[trace.intent]
        near = gr.expand_one(seeds, self.edges, seed="node_id", kinds=kinds).select(F.col("found").alias("node_id"), "score")
        if trace.intent in TWO_STEPS:
            near = near.unionByName(gr.expand_two(seeds, self.edges, seed="node_id", kinds=kinds).select(F.col("found").alias("node_id"), "score"))
        best = near.groupBy("node_id").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "node_id").limit(15)
        cand = best.join(nodes.filter("project_id is not null and workbook_name is not null").select("node_id", "project_id", "workbook_name", "sheet_name").dropDuplicates(["node_id"]), "node_id")
        joined = rt.provenance(cand, rows, candidate="node_id")
        return joined.groupBy("chunk_id").agg(F.max("score").alias("score")).withColumn("source", F.lit("graph"))


def index_chunks(chunks: DataFrame, embed=None) -> DataFrame:
    """Chunks with their vector, ready for ``sources.tables.write_vectors``."""
    return chunks.withColumn("embedding", models.embedded(F.col("embedding_text"), embed))
