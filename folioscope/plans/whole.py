"""Queries that look at whole texts and whole tables, with SQL that does so too.

Each is the query of the name without ``_whole``. The SQL that is registered under that older name holds a cut (a prefix, a
number of rows or of steps), is kept as it was, and differs where the cut matters; the SQL here is written without it.
"""

from __future__ import annotations

from folioscope.functions import rules
from folioscope.operators import linking
from folioscope.plans import documents, experiments, graph, links, text_rules

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _layer(name: str, labels: tuple[str, ...]) -> str:
    n = "(SELECT node_id FROM graph_nodes WHERE label IN (" + ", ".join(f"'{x}'" for x in labels) + "))"
    return f"(SELECT '{name}' AS layer, pos, relationship FROM graph_edges WHERE from_id IN {n} AND to_id IN {n} ORDER BY confidence DESC NULLS LAST, pos LIMIT {linking.LAYER_EDGES})"


QUERIES = {
    "evidence_units_whole": documents.QUERIES["evidence_units"],
    "text_evidence_whole": text_rules.QUERIES["text_evidence"],
    "graph_layer_edges_whole": links.QUERIES["graph_layer_edges"],
    "graph_sheets_near_whole": experiments.QUERIES["graph_sheets_near"],
    "graph_reachable_whole": graph.QUERIES["graph_reachable"],
}
SQL = {
    "evidence_units_whole": rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS c, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE text IS NOT NULL),
        s AS (SELECT *, sum(regexp_matches(c, '^#{{1,4}}\s+')::int) OVER (PARTITION BY doc_id ORDER BY line) AS section FROM l),
        u AS (SELECT doc_id, section, min(line) AS line_start, max(line) AS line_end, length(regexp_replace(string_agg(c, chr(10) ORDER BY line), '^{_SPACE}|{_SPACE}$', '', 'g')) AS chars FROM s GROUP BY 1, 2)
        SELECT doc_id, section, line_start, line_end, chars FROM u WHERE chars > 0""",
    "text_evidence_whole": f"""WITH c AS (SELECT pos, content, lower(content) AS h FROM chunks WHERE content IS NOT NULL)
        SELECT pos, CASE WHEN contains(content, '```mermaid') THEN 'mermaid' WHEN length(content) - length(replace(content, '|', '')) > 4 THEN 'table' ELSE 'section' END AS kind,
          {text_rules._cases("h", rules.SHEET_KINDS, "unknown")} AS sheet_kind,
          {", ".join("(" + " OR ".join(f"contains(content, '{w}')" for w in words) + f") AS {k}" for k, words in rules.FLAG_WORDS.items())} FROM c""",
    "graph_layer_edges_whole": " UNION ALL ".join(_layer(name, labels) for name, labels in (("business", linking.BUSINESS), ("implementation", linking.IMPLEMENTATION))),
    "graph_sheets_near_whole": """WITH s AS (SELECT DISTINCT node_id AS a FROM graph_nodes WHERE contains(lower(name), 'order hub') OR contains(lower(name), 'stock')),
        w AS (SELECT DISTINCT a, b FROM (SELECT from_id AS a, to_id AS b FROM graph_edges UNION ALL SELECT to_id, from_id FROM graph_edges) WHERE a IS NOT NULL AND b IS NOT NULL),
        x AS (SELECT w.b, 1 AS steps FROM s JOIN w USING (a) UNION SELECT v.b, 2 FROM s JOIN w USING (a) JOIN w v ON v.a = w.b)
        SELECT b AS sheet, min(steps) AS steps FROM x WHERE b IN (SELECT node_id FROM graph_nodes WHERE label = 'Sheet') GROUP BY 1""",
    "graph_reachable_whole": """WITH RECURSIVE e AS (SELECT DISTINCT from_id, to_id FROM graph_edges WHERE relationship = 'NEXT_STEP'),
        p(seed, found, steps) USING KEY (seed, found) AS (SELECT DISTINCT node_id, node_id, 0 FROM graph_nodes WHERE label = 'System'
          UNION SELECT p.seed, e.to_id, min(p.steps + 1) FROM p JOIN e ON e.from_id = p.found WHERE NOT EXISTS (SELECT 1 FROM recurring.p r WHERE r.seed = p.seed AND r.found = e.to_id) AND e.to_id IS NOT NULL GROUP BY 1, 2)
        SELECT seed, found, steps FROM p WHERE found <> seed""",
}
