"""Queries of whole flows: hybrid retrieval, ingest, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import models
from folioscope.plans.retriever import Retriever
from folioscope.runtime import table
from folioscope.streaming import ingest


def flow_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector search over the experiments' vectors joined with word search over their texts, fused, boosted, reranked."""
    e = table(spark, sf_dir, "dualrag_experiment_eval_chunks").filter(F.size("embedding") == 1024)
    chunks = e.select(F.col("id").alias("chunk_id"), F.col("text").alias("content"), "embedding", F.col("source_project_id").alias("project_id"), "workbook_name", "sheet_name")
    query = list(chunks.filter("not exists(embedding, x -> isnan(x))").orderBy("chunk_id").select("embedding").first().embedding)
    hits, _ = Retriever(spark, chunks, embed=lambda texts: [query] * len(texts)).retrieve("order status API 在庫 連携", k=10)
    return hits.select("chunk_id", "score", "source")


def flow_graph_guided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with candidates from the graph, over the chunks table with offline vectors of their contents."""
    c = table(spark, sf_dir, "chunks").filter("content is not null").groupBy("chunk_id").agg(F.max_by(F.struct("content", "project_id", "workbook_name", "sheet_name"), F.struct("ingested_at", "pos")).alias("r")).select("chunk_id", "r.*")
    c = c.withColumn("embedding", models.embedded(F.col("content"), models.hashed_embedding(64)))
    r = Retriever(spark, c, table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges"), embed=models.hashed_embedding(64))
    hits, _ = r.retrieve("API sequence of the Order Hub", k=10, graph=True)
    return hits.select("chunk_id", "score", "source")


def stream_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream, counted in tumbling windows of a day."""
    s = ingest.windowed_counts(ingest.stream_table(spark, sf_dir, "events"), time="ts", by="event_type", late="400 days")
    return ingest.run_once(s, "windows", "complete").select(F.col("begin").cast("timestamp_ntz").alias("begin"), "event_type", "events")


def stream_once_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as a stream, those delivered again dropped."""
    s = ingest.once_each(ingest.stream_table(spark, sf_dir, "chunks").select("chunk_id", "ingested_at"), key="chunk_id", time="ingested_at", late="4000 days")
    return ingest.run_once(s.select("chunk_id"), "once")


QUERIES = {f.__name__: f for f in (flow_hybrid, flow_graph_guided, stream_event_windows, stream_once_each)}
SQL = {
    "stream_event_windows": "SELECT date_trunc('day', ts)::timestamp AS begin, event_type, count(*) AS events FROM events GROUP BY 1, 2",
    "stream_once_each": "SELECT DISTINCT chunk_id FROM chunks",
}
