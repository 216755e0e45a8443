"""Endpoints of edges, written in any of several forms, resolved to the ids of nodes.

Strategies in order; the first that knows a reference decides, and each gives one node or none:

* ``exact``: the id itself;
* ``remap``: an id known under another one, from a table of old ids, or one that is the same when normalised;
* ``name``: a name that is that of one node only;
* ``label_name``: project, label and name as ``project:Label:Name``;
* ``global``, ``workbook``, ``sheet``, ``any_scope``: the id that such a text has by the rules of canonical ids, in the
  scope of the project, of the reference's workbook, of its sheet, or in any;
* ``probe``, ``probe_workbook``: the id with each listed prefix before the reference's normalised text;
* ``last_name``, ``last_name_label``: the normalised text behind the last colon, if it names one node, or one of the label.

Null and blank references are ``empty``; what nothing knows is ``unresolved``. Most references are exact and leave
first; the others meet the lookups by left joins on keys, so no reference is dropped or doubled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import ids
from folioscope.functions.text import normalize_id

NAME_CHARS = 50


def _one(table: DataFrame, key: Column, target: str = "node_id", *, only: bool = True) -> DataFrame:
    """(key, target): the only node of a key, or, where several are allowed, the smallest."""
    t = table.select(key.alias("key"), F.col(target).alias("t")).filter("key is not null and key <> ''").groupBy("key").agg(F.min("t").alias("target"), F.max("t").alias("most"))
    return (t.filter("target = most") if only else t).select("key", "target")


def resolve_ends(refs: DataFrame, nodes: DataFrame, *, ref: str = "ref", remap: DataFrame | None = None) -> DataFrame:
    """``refs`` (with project_id, workbook_name, sheet_name) with ``target`` and ``strategy``.

    ``nodes``: node_id, project_id, label, name. ``remap``: old_id, node_id.
    """
    n = nodes.select("node_id", "project_id", "label", "name").filter("node_id is not null").distinct()
    known = n.select(F.col("node_id").alias("key")).distinct().withColumn("target", F.col("key"))
    blank = F.trim(F.coalesce(F.col(ref), F.lit(""))) == ""
    first = refs.join(known.withColumnRenamed("key", "k_"), F.col(ref) == F.col("k_"), "left").drop("k_")
    done = first.filter(blank | F.col("target").isNotNull()).withColumn("target", F.when(~blank, F.col("target"))).withColumn("strategy", F.when(blank, "empty").otherwise("exact"))
    loose = first.filter(~blank & F.col("target").isNull()).drop("target")

    parts = F.split("node_id", ":")
    prefix, project, last = parts[0], parts[1], F.element_at(parts, -1)
    places = F.create_map(*[F.lit(x) for i, p in enumerate(ids.TYPE_PREFIX.values()) for x in (p, i)])
    listed = n.select("node_id").distinct().withColumn("place", F.try_element_at(places, prefix)).filter("place is not null")
    probes = lambda size: listed.filter(F.size(parts) == size).groupBy(F.concat_ws(":", F.slice(parts, 2, size - 1)).alias("key")).agg(F.min_by("node_id", F.struct("place", "node_id")).alias("target"))
    typed = F.split(F.col(ref), ":", 3)
    is_typed = F.size(typed) == 3
    kind, key = ids.type_prefix(typed[1]), F.substring(normalize_id(typed[2]), 1, NAME_CHARS)
    given = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", normalize_id(F.col(c)))
    book, page, own = given("workbook_name"), given("sheet_name"), F.col("project_id")
    scoped = lambda *cs: F.when(is_typed & F.array_size(F.array_compact(F.array(*cs))).eqNullSafe(len(cs)), F.concat_ws(":", kind, *cs))
    end = F.substring(normalize_id(F.element_at(F.split(F.col(ref), ":"), -1)), 1, NAME_CHARS)
    short = F.substring(normalize_id(F.col("name")), 1, NAME_CHARS)
    named = n.filter("trim(coalesce(name, '')) <> ''")
    lookups = [
        *([("remap", F.col(ref), remap.join(known, F.col("node_id") == F.col("key"), "left_semi").groupBy(F.col("old_id").alias("key")).agg(F.min("node_id").alias("target")))] if remap is not None else []),
        ("remap", normalize_id(F.col(ref)), _one(n, normalize_id(F.col("node_id")))),
        ("name", F.col(ref), _one(named, F.col("name"))),
        ("label_name", F.col(ref), _one(named.filter("project_id is not null and label is not null"), F.concat_ws(":", "project_id", "label", "name"), only=False)),
        ("global", scoped(own, key), known),
        ("workbook", scoped(own, book, key), known),
        ("sheet", scoped(own, book, page, key), known),
        ("any_scope", scoped(own, key), _one(n.filter(F.size(parts) >= 3), F.concat_ws(":", prefix, project, last), only=False)),
        ("probe", F.concat(own, F.lit(":"), normalize_id(F.col(ref))), probes(3)),
        ("probe_workbook", F.concat(own, F.lit(":"), book, F.lit(":"), normalize_id(F.col(ref))), probes(4)),
        ("last_name", end, _one(named, short)),
        ("last_name_label", F.when(is_typed, F.concat_ws(":", kind, end)), _one(named, F.concat_ws(":", prefix, short))),
    ]
    out = loose
    for i, (_, on, table) in enumerate(lookups):
        t = table.select(F.col("key").alias(f"k{i}_"), F.col("target").alias(f"t{i}_"))
        out = out.withColumn(f"on{i}_", on).join(t, F.col(f"on{i}_") == F.col(f"k{i}_"), "left").drop(f"k{i}_", f"on{i}_")
    found = [F.col(f"t{i}_") for i in range(len(lookups))]
    names = [F.when(t.isNotNull(), F.lit(name)) for t, (name, _, _) in zip(found, lookups)]
    out = out.withColumn("target", F.coalesce(*found)).withColumn("strategy", F.coalesce(*names, F.lit("unresolved")))
    return done.unionByName(out.drop(*[f"t{i}_" for i in range(len(lookups))]))
