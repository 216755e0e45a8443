"""Queries that guide a search through the graph: hints, layers by terms and sheets, endpoints, and rules of text and status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import rules
from folioscope.functions import text as tx
from folioscope.functions.text import normalize_id  # noqa: F401
from folioscope.operators import endpoints, linking
from folioscope.plans import text_rules
from folioscope.plans.graph import _NORM, _PREFIX, TERMS
from folioscope.runtime import table

LAYER_TERMS = (*TERMS, "dock_date", "マッピング")
#: Review states of the edges as the states that have a confidence.
STATES = {"verified": "CONFIRMED", "pending": "candidate", "rejected": "NEEDS_REVIEW"}


def chunk_type_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of chunks that a text, read as a question, asks for."""
    d = table(spark, sf_dir, "documents").filter("text is not null")
    return d.select("doc_id", rules.chunk_type_hints(F.col("text")).alias("kinds"))


def guided_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets that the graph knows around every reference entry, and how good a hint they are."""
    r = table(spark, sf_dir, "ref_entities")
    return linking.guidance_hints(table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges"), r, key="ref_id", name="name")


def _terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in LAYER_TERMS], "term string")


def layers_by_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of both layers around the nodes that a term names, by keyword only where the names of the layer's main label give none."""
    n, e = table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges")
    return linking.layers_by_terms(n, e, _terms(spark), term="term").select("layer", "term", "way", "pos")


def layers_by_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between the sheets on which a term's nodes lie and nodes of either layer."""
    n, e = table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges")
    return linking.layers_by_sheets(n, e, _terms(spark), term="term").select("layer", "pos")


def graph_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of edges, names and labelled names of nodes, resolved: how many by which strategy."""
    n, e = table(spark, sf_dir, "graph_nodes"), table(spark, sf_dir, "graph_edges")
    none = F.lit(None).cast("string")
    ends = e.select(F.lit("edge").alias("form"), F.explode(F.array("from_id", "to_id")).alias("ref"), "project_id", none.alias("workbook_name"), none.alias("sheet_name"))
    forms = {"name": F.col("name"), "labelled": F.concat_ws(":", "project_id", "label", "name"), "other_case": F.concat_ws(":", "project_id", "label", F.lower("name"))}
    for form, ref in forms.items():
        ends = ends.unionByName(n.filter("project_id is not null and label is not null and name is not null").select(F.lit(form).alias("form"), ref.alias("ref"), "project_id", "workbook_name", "sheet_name"))
    return endpoints.resolve_ends(ends, n).groupBy("form", "strategy").agg(F.count("*").alias("ends"), F.count_distinct("target").alias("nodes"))


def graph_status_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How sure edges are by their state."""
    state = rules.first_match([(F.col("review_status") == k, F.lit(v)) for k, v in STATES.items()], F.lit("other"))
    sure = rules.status_confidence(state)
    return table(spark, sf_dir, "graph_edges").groupBy(sure.alias("sure")).agg(F.count("*").alias("edges"))


def text_query_rewrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node's name, read as a question, with the words added for business wording."""
    q = table(spark, sf_dir, "graph_nodes").filter("name is not null").select("pos", "name", rules.query_intent(F.col("name")).alias("i"))
    return q.select("pos", rules.expanded(F.col("name"), F.col("i.label"), rules.BUSINESS_WORDS).alias("business"))


def text_sheet_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of sheets by tab and workbook, and the numbers in their names."""
    c = table(spark, sf_dir, "chunks").select("pos", F.coalesce("sheet_name", F.lit("")).alias("sheet"), F.coalesce("workbook_name", F.lit("")).alias("book"))
    n = table(spark, sf_dir, "graph_nodes").select("pos", F.coalesce("sheet_name", F.lit("")).alias("sheet"), F.coalesce("name", F.lit("")).alias("book"))
    return c.unionByName(n).select("pos", rules.sheet_tab_kind(F.col("sheet"), F.col("book")).alias("kind"), tx.sheet_number(F.col("sheet")).alias("number"), tx.first_number(F.col("book")).alias("digits"))


def text_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists stored as JSON or as one plain value, and texts with their line breaks written out."""
    c = table(spark, sf_dir, "chunks")
    marked = F.replace(F.col("content"), F.lit("|"), F.lit("<BR />"))
    return c.select("pos", tx.json_list(F.to_json("systems")).alias("systems"), tx.json_list(F.col("chunk_mode")).alias("modes"), F.length(tx.line_breaks(marked)).alias("length"))


def _hint_sql() -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {' OR '.join(f'contains(lower(text), $${w}$$)' for w in words)} THEN '{kind}' END" for kind, words in rules.CHUNK_TYPE_WORDS.items()) + "], lambda x: x IS NOT NULL)"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_TERM_ROWS = "t AS (SELECT unnest([" + ", ".join(f"'{t}'" for t in LAYER_TERMS) + "]) AS term)"
_LAYERS = [(name, main, near, labels) for name, (main, near, labels) in linking.LAYER_LABELS.items()]
_N = lambda labels: f"(SELECT DISTINCT node_id FROM graph_nodes WHERE label IN {_in(labels)})"


def _layer_terms_sql() -> str:
    out = []
    for i, (name, main, near, labels) in enumerate(_LAYERS):
        touch = "(e.from_id = h.node_id AND e.to_id IN {0}) OR (e.to_id = h.node_id AND e.from_id IN {0})"
        out.append(f"""c{i} AS (SELECT DISTINCT h.term, e.pos FROM (SELECT DISTINCT term, node_id FROM t JOIN graph_nodes ON contains(lower(name), lower(term)) AND label IN {_in(main)}) h
              JOIN graph_edges e ON e.from_id = h.node_id AND e.to_id IN {_N(near)} UNION
              SELECT DISTINCT h.term, e.pos FROM (SELECT DISTINCT term, node_id FROM t JOIN graph_nodes ON contains(lower(name), lower(term)) AND label IN {_in(main)}) h
              JOIN graph_edges e ON e.to_id = h.node_id AND e.from_id IN {_N(near)}),
            d{i} AS (SELECT DISTINCT h.term, e.pos FROM (SELECT DISTINCT term, node_id FROM t JOIN graph_nodes ON contains(lower(name), lower(term)) AND label IN {_in(labels)} WHERE term NOT IN (SELECT term FROM c{i})) h
              JOIN graph_edges e ON e.from_id = h.node_id AND e.to_id IN (SELECT node_id FROM graph_nodes) UNION
              SELECT DISTINCT h.term, e.pos FROM (SELECT DISTINCT term, node_id FROM t JOIN graph_nodes ON contains(lower(name), lower(term)) AND label IN {_in(labels)} WHERE term NOT IN (SELECT term FROM c{i})) h
              JOIN graph_edges e ON e.to_id = h.node_id AND e.from_id IN (SELECT node_id FROM graph_nodes))""")
    rows = " UNION ALL ".join(f"SELECT '{name}' AS layer, term, 'names' AS way, pos FROM c{i} UNION ALL SELECT '{name}', term, 'keywords', pos FROM d{i}" for i, (name, *_) in enumerate(_LAYERS))
    return f"WITH {_TERM_ROWS}, {', '.join(out)} {rows}"


def _layer_sheets_sql() -> str:
    sheets = "s AS (SELECT DISTINCT project_id, workbook_name, sheet_name FROM graph_nodes JOIN t ON contains(lower(name), lower(term))), p AS (SELECT DISTINCT node_id FROM graph_nodes SEMI JOIN s USING (project_id, workbook_name, sheet_name) WHERE label = 'Sheet')"
    rows = " UNION ALL ".join(
        f"SELECT DISTINCT '{name}' AS layer, pos FROM graph_edges WHERE (from_id IN (FROM p) AND to_id IN {_N(labels)}) OR (to_id IN (FROM p) AND from_id IN {_N(labels)})" for name, _, _, labels in _LAYERS
    )
    return f"WITH {_TERM_ROWS}, {sheets} {rows}"


def _ends_sql() -> str:
    kind = _PREFIX.replace("CASE label", "CASE split_part(ref, ':', 2)").replace("lower(label)", "lower(split_part(ref, ':', 2))")
    name = "array_to_string(string_split(ref, ':')[3:], ':')"
    one = lambda key, where="true", only=True: f"(SELECT {key} AS k, min(node_id) AS t FROM n WHERE {where} GROUP BY 1 {'HAVING min(node_id) = max(node_id)' if only else ''})"
    norm = _NORM.format
    listed = _in(set(text_rules.ids.TYPE_PREFIX.values()))
    place = "CASE split_part(node_id, ':', 1) " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in reversed(list(enumerate(text_rules.ids.TYPE_PREFIX.values())))) + " END"
    probe = lambda size: f"(SELECT array_to_string(string_split(node_id, ':')[2:], ':') AS k, arg_min(node_id, ({place}, node_id)) AS t FROM n WHERE len(string_split(node_id, ':')) = {size} AND split_part(node_id, ':', 1) IN {listed} GROUP BY 1)"
    short = f"substr({norm('name')}, 1, 50)"
    named = "trim(coalesce(name, '')) <> ''"
    typed = "len(string_split(ref, ':')) >= 3"
    lookups = [
        ("remap", norm("ref"), one(norm("node_id"))),
        ("name", "ref", one("name", named)),
        ("label_name", "ref", one("project_id || ':' || label || ':' || name", f"{named} AND project_id IS NOT NULL AND label IS NOT NULL", False)),
        ("global", "gk", one("node_id")), ("workbook", "wk", one("node_id")), ("sheet", "sk", one("node_id")),
        ("any_scope", "gk", one("split_part(node_id, ':', 1) || ':' || split_part(node_id, ':', 2) || ':' || split_part(node_id, ':', -1)", "len(string_split(node_id, ':')) >= 3", False)),
        ("probe", f"project_id || ':' || {norm('ref')}", probe(3)), ("probe_workbook", f"project_id || ':' || book || ':' || {norm('ref')}", probe(4)),
        ("last_name", "last", one(short, named)), ("last_name_label", "lk", one(f"split_part(node_id, ':', 1) || ':' || {short}", named)),
    ]
    joins = " ".join(f"LEFT JOIN {tab} l{i} ON l{i}.k = x.on{i}" for i, (_, _, tab) in enumerate(lookups))
    ons = ", ".join(f"{on} AS on{i}" for i, (_, on, _) in enumerate(lookups))
    strategy = " ".join(f"WHEN l{i}.t IS NOT NULL THEN '{s}'" for i, (s, _, _) in enumerate(lookups))
    forms = {"name": "name", "labelled": "project_id || ':' || label || ':' || name", "other_case": "project_id || ':' || label || ':' || lower(name)"}
    given = "FROM graph_nodes WHERE project_id IS NOT NULL AND label IS NOT NULL AND name IS NOT NULL"
    return f"""WITH n AS (SELECT DISTINCT node_id, project_id, label, name FROM graph_nodes WHERE node_id IS NOT NULL),
        r AS (SELECT 'edge' AS form, unnest([from_id, to_id]) AS ref, project_id, NULL AS workbook_name, NULL AS sheet_name FROM graph_edges
          {" ".join(f"UNION ALL SELECT '{f}', {e}, project_id, workbook_name, sheet_name {given}" for f, e in forms.items())}),
        f AS (SELECT *, CASE WHEN trim(coalesce(ref, ''), ' ') = '' THEN 'empty' WHEN ref IN (SELECT node_id FROM n) THEN 'exact' END AS early FROM r),
        g AS (SELECT *, {kind} AS kind, substr({norm(name)}, 1, 50) AS key, substr({norm("split_part(ref, ':', -1)")}, 1, 50) AS last, {typed} AS typed,
          CASE WHEN coalesce(workbook_name, '') <> '' THEN {norm("workbook_name")} END AS book, CASE WHEN coalesce(sheet_name, '') <> '' THEN {norm("sheet_name")} END AS page FROM f WHERE early IS NULL),
        k AS (SELECT *, CASE WHEN typed THEN kind || ':' || project_id || ':' || key END AS gk, CASE WHEN typed THEN kind || ':' || project_id || ':' || book || ':' || key END AS wk,
          CASE WHEN typed THEN kind || ':' || project_id || ':' || book || ':' || page || ':' || key END AS sk, CASE WHEN typed THEN kind || ':' || last END AS lk FROM g),
        x AS (SELECT *, {ons} FROM k),
        o AS (SELECT form, early AS strategy, CASE WHEN early = 'exact' THEN ref END AS target FROM f WHERE early IS NOT NULL UNION ALL
          SELECT form, CASE {strategy} ELSE 'unresolved' END, coalesce({", ".join(f"l{i}.t" for i in range(len(lookups)))}) FROM x {joins})
        SELECT form, strategy, count(*) AS ends, count(DISTINCT target) AS nodes FROM o GROUP BY 1, 2"""


_STATE = "CASE review_status " + " ".join(f"WHEN '{k}' THEN {rules.STATUS_CONFIDENCE[v.upper()]}" for k, v in STATES.items()) + " ELSE 0.5 END"

QUERIES = {
    f.__name__: f
    for f in (chunk_type_hints, guided_hints, layers_by_terms, layers_by_sheets, graph_endpoints, graph_status_confidence, text_query_rewrites, text_sheet_tabs, text_lists)
}
SQL = {
    "chunk_type_hints": f"SELECT doc_id, {_hint_sql()} AS kinds FROM documents WHERE text IS NOT NULL",
    "guided_hints": """WITH h AS (SELECT DISTINCT r.ref_id, n.node_id FROM ref_entities r JOIN graph_nodes n ON contains(lower(n.name), lower(r.name)) WHERE trim(r.name) <> ''),
        x AS (SELECT * FROM h UNION SELECT ref_id, to_id FROM h JOIN graph_edges ON from_id = node_id UNION SELECT ref_id, from_id FROM h JOIN graph_edges ON to_id = node_id),
        s AS (SELECT DISTINCT ref_id, project_id, workbook_name, sheet_name FROM x JOIN graph_nodes USING (node_id) WHERE coalesce(workbook_name, '') <> '' AND coalesce(sheet_name, '') <> ''),
        c AS (SELECT ref_id, count(*) AS sheets FROM s GROUP BY 1),
        a AS (SELECT count(*) AS every FROM (SELECT DISTINCT project_id, workbook_name, sheet_name FROM graph_nodes WHERE coalesce(workbook_name, '') <> '' AND coalesce(sheet_name, '') <> '')),
        r AS (SELECT DISTINCT ref_id FROM ref_entities)
        SELECT ref_id, coalesce(sheets, 0) AS sheets, CASE WHEN sheets IS NULL THEN 'none' WHEN sheets > 10 OR sheets > every * 0.5 THEN 'weak' ELSE 'strong' END AS quality FROM r LEFT JOIN c USING (ref_id), a""",
    "layers_by_terms": _layer_terms_sql(),
    "layers_by_sheets": _layer_sheets_sql(),
    "graph_endpoints": _ends_sql(),
    "graph_status_confidence": f"SELECT {_STATE}::double AS sure, count(*) AS edges FROM graph_edges GROUP BY 1",
    "text_query_rewrites": f"""WITH n AS (SELECT pos, name, {text_rules._HITS} FROM graph_nodes WHERE name IS NOT NULL), i AS (SELECT pos, name, {text_rules._INTENT} AS intent FROM n)
        SELECT pos, name || ' ' || CASE intent {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.BUSINESS_WORDS.items())} END AS business FROM i""",
    "text_sheet_tabs": r"""WITH s AS (SELECT pos, coalesce(sheet_name, '') AS sheet, coalesce(workbook_name, '') AS book FROM chunks UNION ALL SELECT pos, coalesce(sheet_name, ''), coalesce(name, '') FROM graph_nodes),
        b AS (SELECT *, sheet || ' ' || book AS both_ FROM s)
        SELECT pos, CASE WHEN contains(sheet, '変更履歴') THEN 'change_history' WHEN (contains(both_, 'API') AND contains(both_, '順序')) OR contains(both_, 'フローチャート') THEN 'flowchart'
          WHEN contains(both_, '開発仕様') THEN 'dev_spec' WHEN contains(sheet, 'データ取得条件') THEN 'data_condition'
          WHEN contains(both_, 'マッピングシート') OR (contains(both_, 'マッピング') AND contains(both_, '定義書')) THEN 'mapping' WHEN contains(sheet, '補足事項') THEN 'supplementary' ELSE 'generic' END AS kind,
          try_cast(nullif(regexp_extract(sheet, '^sheet_([0-9]+)', 1), '') AS INT) AS number, regexp_extract(book, '([0-9]+)', 1) AS digits FROM b""",
    "text_lists": r"""SELECT pos, coalesce(systems, []) AS systems, CASE WHEN chunk_mode IS NULL OR regexp_replace(chunk_mode, '[\s　\x{a0}]+', '', 'g') = '' THEN [] ELSE [chunk_mode] END AS modes,
        length(regexp_replace(replace(content, '|', '<BR />'), '<br\s*/?>', chr(10), 'gi')) AS length FROM chunks""",
}
