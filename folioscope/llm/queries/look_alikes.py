"""Queries of problem 3: texts that look the same but differ in their characters."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import look_alikes
from folioscope.llm.look_alikes import LookAlikes, one_form
from folioscope.runtime import table

FIELDS = (("chunks", "content"), ("graph_nodes", "name"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [
        LookAlikes(table(spark, sf_dir, tab), row_id="pos", text=field).pairs()
        .select(F.lit(tab).alias("tab"), F.col("row_a").alias("pos_a"), F.col("row_b").alias("pos_b"))
        for tab, field in FIELDS
    ]
    return reduce(DataFrame.unionByName, pairs)


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text that takes part, in its one form: the canonical member of its class, or its own mapped form."""
    out = []
    for tab, field in FIELDS:
        rows = table(spark, sf_dir, tab)
        classes = LookAlikes(rows, row_id="pos", text=field).members.select(F.col("row_id").alias("pos"), "class_id", "canonical")
        own = rows.select("pos", F.col(field).alias("raw")).filter(F.col("raw").rlike(r"(?U)\S"))
        out.append(
            own.join(classes, "pos", "left").select(
                F.lit(tab).alias("tab"), "pos", F.coalesce("class_id", "pos").alias("class_pos"),
                F.coalesce("canonical", one_form(F.col("raw"))).alias("one_form"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def _sql(tab: str, field: str) -> str:
    nothing = re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", look_alikes.NOTHING)
    joiner = re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", look_alikes.JOINER.replace("(?=", "("))
    quoted = [s.replace("'", "''") for s in look_alikes.character_map()]
    shown = f"regexp_replace(regexp_replace({field}, '{joiner}', '\\1\ue0a0\\2', 'g'), '{nothing}', '', 'g')"
    return f"""SELECT pos, {field} AS raw, nfc_normalize(translate({shown}, '{quoted[0]}', '{quoted[1]}')) AS look FROM {tab} WHERE {field} IS NOT NULL"""


def _pairs(tab: str, field: str) -> str:
    return f"""SELECT '{tab}' AS tab, a.pos AS pos_a, b.pos AS pos_b FROM {tab}_looks a JOIN {tab}_looks b ON a.look = b.look AND a.pos < b.pos AND a.raw <> b.raw
        WHERE regexp_replace(a.look, '\\s+', '', 'g') <> ''"""


QUERIES = {"p3_found": p3_found, "p3_canonical": p3_canonical}
SQL = {"p3_found": "WITH " + ", ".join(f"{t}_looks AS ({_sql(t, f)})" for t, f in FIELDS) + " " + " UNION ALL ".join(_pairs(t, f) for t, f in FIELDS)}
