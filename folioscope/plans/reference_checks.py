"""Queries of problem 2: references to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.references import find_orphans, orphans_by_period
from folioscope.runtime import table


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_orphans(table(spark, sf_dir, "graph_edges"), table(spark, sf_dir, "graph_nodes"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select(F.col("row_id").alias("pos"), "side")


def p2_orphans_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans_by_period(_orphans(spark, sf_dir), "graph_edges")


_REFS = """
refs AS (SELECT pos, side, ref, ref_at FROM (
    SELECT pos, 'from_id' AS side, from_id AS ref, created_at AS ref_at FROM graph_edges
    UNION ALL SELECT pos, 'to_id', to_id, created_at FROM graph_edges)
  WHERE ref IS NOT NULL AND regexp_matches(ref, '\\S')),
orphans AS (SELECT r.* FROM refs r WHERE NOT EXISTS (
    SELECT 1 FROM graph_nodes n WHERE n.node_id = r.ref AND n.created_at <= r.ref_at
      AND (n.deleted_at IS NULL OR n.deleted_at > r.ref_at)))
"""

QUERIES = {"p2_found": p2_found, "p2_orphans_by_month": p2_orphans_by_month}
SQL = {
    "p2_found": f"WITH {_REFS} SELECT pos, side FROM orphans",
    "p2_orphans_by_month": f"""WITH {_REFS}
        SELECT 'graph_edges' AS ref_table, side AS ref_field, date_trunc('month', ref_at)::timestamp AS period,
               count(*) AS orphans, count(DISTINCT ref) AS missing_keys
        FROM orphans GROUP BY 2, 3""",
}
