"""Queries of problem 5: names and labels typed by hand, mapped to the reference entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.canonical_values import map_to_canonical
from folioscope.runtime import table


def _manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "graph_nodes").filter(F.col("properties")["origin"] == "manual")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_to_canonical(_manual(spark, sf_dir), table(spark, sf_dir, "ref_entities")).select(F.col("row_id").alias("pos"), "ref_id")


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed names without an entry, with the number of rows."""
    rows = _manual(spark, sf_dir)
    missed = map_to_canonical(rows, table(spark, sf_dir, "ref_entities")).filter("ref_id = 0").select(F.col("row_id").alias("pos"))
    return rows.select("pos", "name").join(missed, "pos").groupBy("name").agg(F.count("*").alias("rows"))


QUERIES = {"p5_found": p5_found, "p5_unmatched": p5_unmatched}
SQL: dict[str, str] = {}
