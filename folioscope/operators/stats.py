"""Statistics of chunks and links between documents by what they share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upper_median(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, upper_median): the element with number n // 2 (from 0) in sorted order.

    From counts per value, which combine on the map side, so no group's rows are gathered or sorted.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("c_"))
    over = Window.partitionBy(*by)
    placed = counts.withColumn("upto_", F.sum("c_").over(over.orderBy(value))).withColumn("n_", F.sum("c_").over(over))
    return placed.filter(F.col("upto_") > F.floor(F.col("n_") / 2)).groupBy(*by).agg(F.min(value).alias("upper_median"))


def length_stats(df: DataFrame, by: Sequence[str], value: str, **flags: Column) -> DataFrame:
    """Count, mean, least, most, upper median of a value and how many rows have each flag."""
    v = F.col(value)
    base = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.round(F.avg(v), 1).alias("mean"), F.min(v).alias("least"), F.max(v).alias("most"), *[F.count_if(c).alias(k) for k, c in flags.items()]
    )
    return base.join(upper_median(df, by, value), list(by), "left")


def best_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """(project_id, diagram, book, shared): of every diagram the book that shares most words with it, ties by name.

    Words that join are counted per pair with a partial aggregate; words are equal keys, so nothing is compared with everything.
    """
    pairs = left.join(right, ["project_id", "word"]).groupBy("project_id", "diagram", "book").agg(F.count("*").alias("shared"))
    best = F.min_by(F.struct("book", "shared"), F.struct((-F.col("shared")).alias("s"), F.col("book")))
    return pairs.groupBy("project_id", "diagram").agg(best.alias("b")).select("project_id", "diagram", "b.book", "b.shared")
