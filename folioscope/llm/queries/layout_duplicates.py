"""Queries of problem 1: the same content in another layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.merkle import LayoutIndex
from folioscope.runtime import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = LayoutIndex(table(spark, sf_dir, "chunks")).copies()
    return copies.select(F.col("first_row").alias("first_pos"), F.col("row_id").alias("copy_pos"))


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct content that occurs, with the number of its copies."""
    return LayoutIndex(table(spark, sf_dir, "chunks")).distinct().select(F.col("first_row").alias("first_pos"), "copies")


_CLASSES = r"""
leaves AS (
  SELECT pos, coalesce(chunk_type = 'field_def', false) AS f,
    CASE WHEN coalesce(chunk_type = 'field_def', false)
      THEN list_sort(list_filter(list_transform(regexp_split_to_array(content, '\r\n|[\n\r\f\v\x{85}\x{2028}\x{2029}]'),
             lambda x: lower(regexp_replace(x, '[^\p{L}\p{N}]+', '', 'g'))), lambda y: y <> ''))
      ELSE list_filter([lower(regexp_replace(content, '[^\p{L}\p{N}]+', '', 'g'))], lambda y: y <> '') END AS s
  FROM chunks WHERE content IS NOT NULL),
keyed AS (SELECT pos, f, s, min(pos) OVER (PARTITION BY f, s) AS first_pos FROM leaves WHERE len(s) > 0)
"""

QUERIES = {"p1_found": p1_found, "p1_classes": p1_classes}
SQL = {
    "p1_found": f"WITH {_CLASSES} SELECT first_pos, pos AS copy_pos FROM keyed WHERE pos > first_pos",
    "p1_classes": f"WITH {_CLASSES} SELECT first_pos, count(*) AS copies FROM keyed GROUP BY first_pos",
}
