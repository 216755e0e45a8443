"""Queries of problem 4: contents over the limit of their mode, cut at natural boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.splitting import split_all, split_oversized
from folioscope.runtime import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = split_oversized(table(spark, sf_dir, "chunks"), table(spark, sf_dir, "chunk_limits"))
    return cut.filter(F.size("pieces") > 1).select(F.col("row_id").alias("pos"))


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every content as ordered pieces, with the section kept."""
    out = split_all(table(spark, sf_dir, "chunks"), table(spark, sf_dir, "chunk_limits"))
    return out.select(F.col("row_id").alias("pos"), "piece_no", F.col("section").alias("section_name"), "start", "overlap", "piece")


QUERIES = {"p4_found": p4_found, "p4_pieces": p4_pieces}
SQL = {
    "p4_found": r"""
        SELECT c.pos FROM chunks c JOIN chunk_limits l
          ON l.chunk_mode = CASE WHEN regexp_replace(coalesce(c.chunk_mode, ''), '\s+', '', 'g') = '' THEN 'semantic'
                                 ELSE lower(regexp_replace(c.chunk_mode, '^\s+|\s+$', '', 'g')) END
        WHERE length(c.content) > l.max_chars"""
}
