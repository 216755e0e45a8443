"""Queries of problem 9: pages of repeated keywords, links or tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.spam_pages import find_spam
from folioscope.runtime import table


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_spam(table(spark, sf_dir, "documents"), table(spark, sf_dir, "spam_labels")).select("doc_id")


def p9_spam_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spam pages per source and language tag (in lower case)."""
    docs = table(spark, sf_dir, "documents")
    found = find_spam(docs, table(spark, sf_dir, "spam_labels")).select("doc_id")
    return docs.join(found, "doc_id", "left_semi").groupBy("source", F.lower("lang").alias("lang")).agg(F.count("*").alias("pages"))


QUERIES = {"p9_found": p9_found, "p9_spam_by_source": p9_spam_by_source}
SQL: dict[str, str] = {}
