"""Queries of retrieval: nearest neighbours, lexical search, fusion, provenance, rerank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import retrieval as rt
from folioscope.runtime import table

#: The query of the registered plans: the vector of this row, and these words.
QUERY_ROW, WORDS = 0, ("shipment", "order", "API", "在庫", "Warehouse")


def _query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return table(spark, sf_dir, "embeddings").filter(F.col("vec_id") == QUERY_ROW).first().embedding


def _vectors(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return rt.nearest(e, _query_vector(spark, sf_dir), k, key="vec_id").select(F.col("vec_id").alias("doc_id"), "distance", "score")


def _words(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    return rt.keyword_search(table(spark, sf_dir, "documents").select("doc_id", "text"), WORDS, k, key="doc_id")


def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir, 10).select("doc_id", "score")


def vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return rt.nearest(e, _query_vector(spark, sf_dir), 10, key="vec_id", where=F.col("label").isin(1, 2, 3)).select("vec_id", "label", "score")


def vector_topk_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 100 as a query, against all rows."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    q = e.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    return rt.nearest_join(e, q, 5, key="vec_id", query_key="query_id").select("query_id", "vec_id", "rank", F.round("distance", 4).alias("distance"))


def keyword_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir, 20).select("doc_id", "score")


def keyword_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = rt.keyword_boost(_words(spark, sf_dir, 20), ("order", "在庫", "order"))
    return hits.select("doc_id", "score")


def hybrid_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.fuse(_vectors(spark, sf_dir, 20), _words(spark, sf_dir, 20), key="doc_id", k=15)


def guided_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.fuse_guided(_words(spark, sf_dir, 20), _vectors(spark, sf_dir, 20), key="doc_id", k=15)


def new_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.new_only(_words(spark, sf_dir, 20).select("doc_id", "score"), _vectors(spark, sf_dir, 200).select("doc_id"), key="doc_id")


def rank_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = _words(spark, sf_dir, 20)
    return rt.compare_ranks(before, rt.keyword_boost(before, ("order", "在庫", "mapping")), key="doc_id")


def rerank_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.rerank(_words(spark, sf_dir, 50), rt.lexical_model("order status of the Warehouse 在庫"), key="doc_id", text="text").select("doc_id", "score", F.round("model_score", 4).alias("model_score"))


def provenance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the sheets that the experiments embedded, by sheet or else by workbook."""
    e = table(spark, sf_dir, "dualrag_experiment_eval_chunks").filter("source_project_id is not null and workbook_name <> ''")
    cand = e.groupBy(F.col("source_project_id").alias("project_id"), "workbook_name", "sheet_name").agg(F.min("id").alias("node_id"), F.lit(0.6).alias("score"))
    return rt.provenance(cand, table(spark, sf_dir, "chunks"), candidate="node_id")


_W = " + ".join(f"contains(text, '{w}')::int" for w in WORDS)
_D = "list_sum(list_transform(list_zip(e.embedding, q.embedding), lambda x: (x[1]::double - x[2]::double) * (x[1]::double - x[2]::double)))"
_VEC = f"v AS (SELECT e.vec_id AS doc_id, e.label, {_D} AS d, round(1 / (1 + {_D}), 4) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = {QUERY_ROW}) q)"
_KEY = f"k AS (SELECT doc_id, text, round(({_W}) / {len(WORDS)}.0, 4) AS score FROM documents WHERE ({_W}) > 0 ORDER BY score DESC, doc_id LIMIT 20)"
_BOOST = "round(least(1.0, score + least(0.08, 0.02 * ({0}))), 4)"

QUERIES = {
    f.__name__: f
    for f in (
        vector_topk, vector_topk_filtered, vector_topk_per_query, keyword_topk, keyword_boost, hybrid_merge, guided_merge, new_candidates, rank_comparison,
        rerank_lexical, provenance_join,
    )
}
SQL = {
    "vector_topk": f"WITH {_VEC} SELECT doc_id, score FROM v ORDER BY d, doc_id LIMIT 10",
    "vector_topk_filtered": f"WITH {_VEC} SELECT doc_id AS vec_id, label, score FROM v WHERE label IN (1, 2, 3) ORDER BY d, doc_id LIMIT 10",
    "vector_topk_per_query": f"""WITH p AS (SELECT q.vec_id AS query_id, e.vec_id, {_D} AS d FROM embeddings e, (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 100 = 0) q),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM p)
        SELECT query_id, vec_id, rank, round(d, 4) AS distance FROM r WHERE rank <= 5""",
    "keyword_topk": f"WITH {_KEY} SELECT doc_id, score FROM k",
    "keyword_boost": f"WITH {_KEY} SELECT doc_id, {_BOOST.format("2 * contains(lower(text), 'order')::int + contains(text, '在庫')::int")} AS score FROM k",
    "hybrid_merge": f"""WITH {_VEC}, {_KEY}, w AS (SELECT doc_id, round(score * 0.9, 4) AS s FROM k), t AS (SELECT doc_id, score AS s FROM v ORDER BY d, doc_id LIMIT 20)
        SELECT coalesce(t.doc_id, w.doc_id) AS doc_id, greatest(t.s, w.s) AS score, CASE WHEN t.s IS NOT NULL AND (w.s IS NULL OR t.s >= w.s) THEN 'vector' ELSE 'keyword' END AS source,
          t.s IS NOT NULL AND w.s IS NOT NULL AS in_both FROM t FULL JOIN w ON t.doc_id = w.doc_id ORDER BY score DESC, doc_id LIMIT 15""",
    "guided_merge": f"""WITH {_VEC}, {_KEY}, t AS (SELECT doc_id, score AS s FROM v ORDER BY d, doc_id LIMIT 20)
        SELECT coalesce(k.doc_id, t.doc_id) AS doc_id, CASE WHEN k.score IS NULL THEN t.s WHEN t.s IS NULL THEN least(1.0, round(k.score + 0.05, 4)) ELSE k.score END AS score,
          CASE WHEN k.score IS NULL THEN 'standard' ELSE 'guided' END AS source FROM k FULL JOIN t ON k.doc_id = t.doc_id ORDER BY score DESC, doc_id LIMIT 15""",
    "new_candidates": f"""WITH {_VEC}, {_KEY}, t AS (SELECT doc_id FROM v ORDER BY d, doc_id LIMIT 200) SELECT doc_id, score FROM k WHERE doc_id NOT IN (SELECT doc_id FROM t)""",
    "rank_comparison": f"""WITH {_KEY}, b AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank_before,
          {_BOOST.format("contains(lower(text), 'order')::int + contains(text, '在庫')::int + contains(lower(text), 'mapping')::int")} AS s FROM k),
        a AS (SELECT *, row_number() OVER (ORDER BY s DESC, doc_id) AS rank_after FROM b) SELECT doc_id, rank_before, rank_after, rank_before - rank_after AS moved FROM a""",
    "rerank_lexical": f"""WITH k AS (SELECT doc_id, lower(text) AS t, round(({_W}) / {len(WORDS)}.0, 4) AS score FROM documents WHERE ({_W}) > 0 ORDER BY score DESC, doc_id LIMIT 50),
        c AS (SELECT * FROM k ORDER BY score DESC, doc_id LIMIT 30),
        m AS (SELECT *, ({" + ".join(f"contains(t, '{w}')::int" for w in ("order", "status", "of", "the", "warehouse", "在庫"))}) / 6.0 AS s FROM c)
        SELECT doc_id, score, round(s, 4) AS model_score FROM m ORDER BY s DESC, score DESC, doc_id LIMIT 5""",
    "provenance_join": """WITH c AS (SELECT source_project_id AS project_id, workbook_name, sheet_name, min(id) AS node_id, 0.6 AS score FROM dualrag_experiment_eval_chunks
            WHERE source_project_id IS NOT NULL AND workbook_name <> '' GROUP BY 1, 2, 3),
        k AS (SELECT DISTINCT project_id, workbook_name, sheet_name, chunk_id FROM chunks WHERE coalesce(workbook_name, '') <> ''),
        e AS (SELECT c.node_id, k.chunk_id, 1 AS tier, c.score FROM c JOIN k USING (project_id, workbook_name, sheet_name) WHERE coalesce(c.sheet_name, '') <> ''
            AND c.workbook_name <> ''),
        b AS (SELECT c.node_id, k.chunk_id, 2 AS tier, c.score * 0.7 AS score FROM c JOIN k USING (project_id, workbook_name) WHERE c.node_id NOT IN (SELECT node_id FROM e)),
        r AS (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY chunk_id) AS n FROM (FROM e UNION ALL FROM b))
        SELECT node_id, chunk_id, tier, round(score, 4) AS score FROM r WHERE n <= 3""",
}
