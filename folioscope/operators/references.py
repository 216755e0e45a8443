"""References to records that do not exist (problem 2).

A reference names a parent key at a point in time. It is an orphan if no parent row with that key
was alive then. Method: a Bloom filter of all parent keys, broadcast (its size is bounded, see
``bloom``), proves most orphans at once; only the references that pass it are joined exactly with
the parents' life spans.

Defined results:

* null and blank references are no references and give no row;
* keys are compared as stored, every character counts;
* a reference without a time is an orphan, since no parent can be shown to have been alive;
* a parent row without a start is never alive; one without an end lives on;
* repeated child rows count each; repeated parent rows change nothing, and the life spans of a key that
  touch or overlap are one;
* an empty parent table makes every reference an orphan; an empty child table gives no rows;
* other columns of either table are ignored, whatever their names.

Hot keys: one key may be named by a third of all references. Keys with more than 1/32 of the
references (so at most 31 of them, a proven bound for the broadcast) are salted: their references
are dealt to ``salts`` buckets and their life spans are copied to each bucket. The spans of a key are first
brought to disjoint ones in sorted order, so a key with many parent rows and many references isn't compared row
by row: a parent row that begins within the span before it adds nothing to it but a later end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators import bloom as bf

HOT_SHARE = 32


def references(child: DataFrame, *, row_id: str, fields: Sequence[str], time: str) -> DataFrame:
    """One row per reference: row_id, side, ref, at."""
    sides = F.array(*[F.struct(F.lit(f).alias("side"), F.col(f).cast("string").alias("ref")) for f in fields])
    return (
        child.select(F.col(row_id).alias("row_id"), F.col(time).alias("at"), F.explode(sides).alias("r"))
        .select("row_id", "at", "r.side", "r.ref")
        .filter(F.col("ref").rlike(r"(?U)\S"))
    )


def disjoint(spans: DataFrame) -> DataFrame:
    """(p_key, p_from, p_until) of each key as spans that neither touch nor overlap.

    Repeated rows are dropped before the sort, those with the same start keep their latest end.
    """
    ends = F.when(F.count("p_until") == F.count("*"), F.max("p_until"))  # null, still alive, if one of them is
    spans = spans.groupBy("p_key", "p_from").agg(ends.alias("p_until"), (F.count("p_until") < F.count("*")).alias("open"))
    spans = spans.filter(F.col("open") | (F.col("p_until") > F.col("p_from")))
    in_order = Window.partitionBy("p_key").orderBy("p_from")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    begun = spans.withColumn("begins", F.coalesce(~F.max("open").over(before) & (F.max("p_until").over(before) < F.col("p_from")), F.max("open").over(before).isNull()))
    numbered = begun.withColumn("span", F.count_if("begins").over(in_order))
    return numbered.groupBy("p_key", "span").agg(F.min("p_from").alias("p_from"), F.when(~F.max("open"), F.max("p_until")).alias("p_until")).drop("span")


def find_orphans(
    child: DataFrame,
    parent: DataFrame,
    *,
    row_id: str = "pos",
    fields: Sequence[str] = ("from_id", "to_id"),
    time: str = "created_at",
    key: str = "node_id",
    alive_from: str = "created_at",
    alive_until: str = "deleted_at",
    salts: int = 16,
) -> DataFrame:
    """Orphan references as rows (row_id, side, ref, at). See the module's text."""
    refs = references(child, row_id=row_id, fields=fields, time=time)
    spans = parent.select(
        F.col(key).cast("string").alias("p_key"), F.col(alive_from).alias("p_from"), F.col(alive_until).alias("p_until")
    ).filter("p_key is not null and p_from is not null")

    blocks = bf.blocks_for(parent.count())
    probed = bf.probe(refs, F.col("ref"), bf.build(spans, F.col("p_key"), blocks), blocks, "maybe")
    proven = probed.filter(~F.col("maybe")).drop("maybe")
    maybe = probed.filter("maybe").drop("maybe")

    spans = disjoint(spans)
    least = max(1000, child.count() * len(fields) // HOT_SHARE)
    hot = F.broadcast(maybe.groupBy("ref").count().filter(F.col("count") > least).select(F.col("ref").alias("hot_key")))
    dealt = (
        maybe.join(hot, F.col("ref") == F.col("hot_key"), "left")
        .withColumn("salt", F.when(F.col("hot_key").isNotNull(), F.pmod(F.xxhash64("row_id"), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
        .drop("hot_key")
    )
    copied = (
        spans.join(hot, F.col("p_key") == F.col("hot_key"), "left")
        .withColumn("p_salt", F.explode(F.when(F.col("hot_key").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
        .drop("hot_key")
    )
    alive = (
        (F.col("ref") == F.col("p_key"))
        & (F.col("salt") == F.col("p_salt"))
        & (F.col("p_from") <= F.col("at"))
        & (F.col("p_until").isNull() | (F.col("p_until") > F.col("at")))
    )
    verified = dealt.join(copied, alive, "left_anti").drop("salt")
    return proven.unionByName(verified)


def orphans_by_period(orphans: DataFrame, table: str, period: str = "month") -> DataFrame:
    """Orphan references counted per table, field and period of the referring row."""
    return (
        orphans.groupBy(F.col("side").alias("ref_field"), F.date_trunc(period, "at").alias("period"))
        .agg(F.count("*").alias("orphans"), F.count_distinct("ref").alias("missing_keys"))
        .select(F.lit(table).alias("ref_table"), "ref_field", "period", "orphans", "missing_keys")
    )
