"""Queries of problem 7: the corpus as token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.encoding import encode_corpus
from folioscope.runtime import table


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, tokens and characters per language tag (in lower case)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("lang").alias("lang"), F.length("text").alias("chars"))
    n = encode_corpus(table(spark, sf_dir, "documents")).select("doc_id", F.size("ids").alias("tokens"))
    return docs.join(n, "doc_id").groupBy("lang").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.sum("chars").alias("chars"))


QUERIES = {"p7_ids": p7_ids, "p7_token_counts": p7_token_counts}
SQL: dict[str, str] = {}
