"""Queries of problem 8: evaluation items leaked into documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.leakage import find_leaks
from folioscope.runtime import table


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return leaks.filter("exact").select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact leaks and paraphrases, with how each was told."""
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), paraphrase=0.7)
    return leaks.select("doc_id", "item_id", F.round("cosine", 4).alias("cosine"), F.when(F.col("exact"), "run").otherwise("paraphrase").alias("kind"))


QUERIES = {"p8_found": p8_found, "p8_leaks": p8_leaks}
SQL = {
    # Candidates share one of the document's consecutive pieces of 25 characters, of which a run of 50 holds at least one.
    "p8_found": r"""WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
        i AS (SELECT item_id, regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g') AS t FROM eval_items WHERE text IS NOT NULL),
        g AS (SELECT DISTINCT item_id, substr(t, k, 25) AS piece FROM (SELECT item_id, t, unnest(range(1, length(t) - 23)) AS k FROM i WHERE length(t) >= 50)),
        p AS (SELECT DISTINCT doc_id, t, piece FROM (SELECT doc_id, t, unnest(regexp_extract_all(t, '(?s).{25}')) AS piece FROM d WHERE length(t) >= 50)),
        c AS (SELECT DISTINCT p.doc_id, p.t AS doc, i.item_id, i.t AS item FROM p JOIN g USING (piece) JOIN i ON i.item_id = g.item_id),
        r AS (SELECT *, unnest(range(1, length(item) - 48)) AS k FROM c)
        SELECT DISTINCT doc_id, item_id FROM r WHERE contains(doc, substr(item, k, 50))""",
}
