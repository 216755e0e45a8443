"""Queries of problem 6: the five most similar vectors of every vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.similar_vectors import k_most_similar, neighbour_pairs
from folioscope.runtime import table

TABLE = "dualrag_experiment_eval_chunks"


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_pairs(k_most_similar(table(spark, sf_dir, TABLE), k=5))


def p6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's neighbours in order."""
    near = k_most_similar(table(spark, sf_dir, TABLE), k=5)
    return near.select("id", F.posexplode("near").alias("place", "n")).select("id", (F.col("place") + 1).alias("rank"), F.col("n.id").alias("neighbour"), F.round("n.cosine", 3).alias("cosine"))


QUERIES = {"p6_found": p6_found, "p6_neighbours": p6_neighbours}
SQL: dict[str, str] = {}
