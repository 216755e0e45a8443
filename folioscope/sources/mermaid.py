"""Mermaid flowcharts: a line parser, a Markdown summary and graph rows."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Shapes of nodes and what they mean.
SHAPES = (
    (re.compile(r'(\w+)\s*\(\[\s*"?(.*?)"?\s*\]\)'), "terminal"),
    (re.compile(r'(\w+)\s*\[\[\s*"?(.*?)"?\s*\]\]'), "subprocess"),
    (re.compile(r'(\w+)\s*\{\s*"?(.*?)"?\s*\}'), "decision"),
    (re.compile(r'(\w+)\s*\[\s*"?(.*?)"?\s*\]'), "process"),
)
_ARROW = re.compile(r'^\s*(\w+)\s*(?:-->|---|-\.->|==>)\s*(?:\|\s*"?(.*?)"?\s*\|)?\s*(\w+)')
_DOTTED = re.compile(r'^\s*(\w+)\s*-\.\s*"?(.*?)"?\s*\.->\s*(\w+)')
_BLOCK = re.compile(r"(?s)```mermaid\n(.*?)\n```")


@dataclass
class Diagram:
    nodes: list[dict] = field(default_factory=list)
    edges: list[dict] = field(default_factory=list)
    subgraphs: list[dict] = field(default_factory=list)


def _clean(label: str) -> str:
    return re.sub(r"(?i)<br\s*/?>", "\n", label).strip()


def parse(source: str) -> Diagram:
    """Nodes (id, label, type, subgraph), edges (source, target, label) and subgraphs (id, title, nodes).

    Subgraphs nest; a node belongs to the innermost one that is open at its first mention. Comments and style lines are skipped.
    """
    out, open_, seen = Diagram(), [], {}

    def mention(node: str, label: str | None = None, kind: str | None = None) -> None:
        if node not in seen:
            seen[node] = {"id": node, "label": node, "type": "annotation" if re.fullmatch(r"A\d+", node) else "process", "subgraph": open_[-1]["id"] if open_ else ""}
            out.nodes.append(seen[node])
            if open_:
                open_[-1]["nodes"].append(node)
        if label is not None:
            seen[node]["label"] = _clean(label)
            if seen[node]["type"] != "annotation":
                seen[node]["type"] = kind

    for raw in source.split("\n"):
        line = raw.strip()
        if not line or line.startswith(("%%", "classDef", "class ", "style ", "linkStyle", "flowchart", "graph ")):
            continue
        if line.startswith("subgraph"):
            m = re.match(r'subgraph\s+(\w+)?\s*\[?\s*"?(.*?)"?\s*\]?$', line)
            name, title = (m[1] or f"sub{len(out.subgraphs) + 1}", m[2] or m[1] or "") if m else (f"sub{len(out.subgraphs) + 1}", "")
            open_.append({"id": name, "title": _clean(title), "nodes": []})
            out.subgraphs.append(open_[-1])
            continue
        if line == "end":
            if open_:
                open_.pop()
            continue
        bare = line
        for pattern, kind in SHAPES:
            for m in pattern.finditer(bare):
                mention(m[1], m[2], kind)
            bare = pattern.sub(lambda m: m[1], bare)
        m = _DOTTED.match(bare)
        if m:
            a, label, b = m[1], m[2], m[3]
        else:
            m = _ARROW.match(bare)
            if not m:
                continue
            a, label, b = m[1], m[2] or "", m[3]
        mention(a)
        mention(b)
        out.edges.append({"source": a, "target": b, "label": _clean(label)})
    return out


def fenced(markdown: str) -> list[str]:
    """The closed Mermaid blocks of a Markdown text."""
    return _BLOCK.findall(markdown)


def to_markdown(name: str, diagram: Diagram, source: str) -> str:
    """A document with the sections that the Mermaid splitter knows."""
    labels = {n["id"]: n["label"] for n in diagram.nodes}
    lines = [f"# {name}", "", "### Overview", f"{len(diagram.nodes)} nodes, {len(diagram.edges)} edges, {len(diagram.subgraphs)} modules", "", "### Functional Modules"]
    lines += [f"- **{s['title'] or s['id']}**: {', '.join(labels[n] for n in s['nodes'])}" for s in diagram.subgraphs]
    lines += ["", "### Nodes", "| ID | Label | Type | Subgraph |", "|---|---|---|---|"]
    lines += [f"| {n['id']} | {n['label'].replace(chr(10), ' ')} | {n['type']} | {n['subgraph']} |" for n in diagram.nodes]
    lines += ["", "### Edges", "| From | To | Label |", "|---|---|---|"]
    lines += [f"| {e['source']} | {e['target']} | {e['label']} |" for e in diagram.edges]
    lines += ["", "### Decision Points"]
    for n in diagram.nodes:
        if n["type"] == "decision":
            lines.append(f"- {n['label']}: " + "; ".join(f"{e['label'] or 'next'} -> {labels[e['target']]}" for e in diagram.edges if e["source"] == n["id"]))
    lines += ["", "### Business Flow", *[f"{i}. {labels[e['source']]} -> {labels[e['target']]}" for i, e in enumerate(diagram.edges, 1)]]
    return "\n".join([*lines, "", "### Original Mermaid Source", "```mermaid", source.strip(), "```"])


# Entity types of node types, and how sure each kind of row is.
ENTITY_TYPES = {"process": "FlowNode", "decision": "DecisionPoint", "annotation": "Annotation", "start": "StartEndNode", "end": "StartEndNode", "terminal": "FlowNode", "subprocess": "FlowNode", "io": "FileObject", "database": "DataEntity"}
SURE = {"module": 0.92, "node": 0.90, "edge": 0.92, "member": 0.95}


def to_graph(diagram: Diagram, prefix: str) -> tuple[list[dict], list[dict]]:
    """Graph rows: a FunctionModule per subgraph, a node per node, NEXT_STEP or BRANCHES_TO per edge, CONTAINS_STEP per member."""
    kinds = {n["id"]: n["type"] for n in diagram.nodes}
    nodes = [{"id": f"{prefix}:{s['id']}", "entity_type": "FunctionModule", "name": s["title"] or s["id"], "confidence": SURE["module"]} for s in diagram.subgraphs]
    nodes += [{"id": f"{prefix}:{n['id']}", "entity_type": ENTITY_TYPES.get(n["type"], "FlowNode"), "name": n["label"], "confidence": SURE["node"]} for n in diagram.nodes]
    edges = [{"from": f"{prefix}:{e['source']}", "to": f"{prefix}:{e['target']}", "type": "BRANCHES_TO" if kinds[e["source"]] == "decision" else "NEXT_STEP", "label": e["label"], "confidence": SURE["edge"]} for e in diagram.edges]
    edges += [{"from": f"{prefix}:{s['id']}", "to": f"{prefix}:{n}", "type": "CONTAINS_STEP", "label": "", "confidence": SURE["member"]} for s in diagram.subgraphs for n in s["nodes"]]
    return nodes, edges
