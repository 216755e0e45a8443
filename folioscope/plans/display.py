"""Small graphs as text: compact lists, tables, networks, Mermaid. What is shown is cut to a stated size first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_NODES, MOST_EDGES = 50, 80


def limited(nodes: DataFrame, edges: DataFrame, *, most_nodes: int = MOST_NODES, most_edges: int = MOST_EDGES) -> tuple[list, list]:
    """The first nodes by id, and the first edges between them by id, as rows on the driver (a fixed number)."""
    shown = nodes.select("node_id", F.coalesce("label", F.lit("Entity")).alias("label"), F.coalesce("name", "node_id").alias("name")).orderBy("node_id").limit(most_nodes).collect()
    ids = [r.node_id for r in shown]
    links = edges.filter(F.col("from_id").isin(ids) & F.col("to_id").isin(ids)).select("id", "from_id", "to_id", "relationship").orderBy("id").limit(most_edges).collect()
    return shown, links


def compact(nodes: list, edges: list) -> str:
    names = {n.node_id: f"{n.name} [{n.label}]" for n in nodes}
    return "\n".join(f"{names[e.from_id]} -{e.relationship}-> {names[e.to_id]}" for e in edges)


def table(nodes: list, edges: list) -> str:
    rows = [("id", "label", "name"), *((n.node_id, n.label, n.name) for n in nodes)]
    width = [max(len(str(r[i])) for r in rows) for i in range(3)]
    return "\n".join("  ".join(str(c).ljust(w) for c, w in zip(r, width)).rstrip() for r in rows) + f"\n{len(edges)} edges"


def network(nodes: list, edges: list) -> str:
    names = {n.node_id: n.name for n in nodes}
    out = []
    for n in nodes:
        out.append(n.name)
        out += [f"  |- {e.relationship} -> {names[e.to_id]}" for e in edges if e.from_id == n.node_id]
    return "\n".join(out)


def to_mermaid(nodes: list, edges: list) -> str:
    """A flowchart whose order depends on the ids only."""
    number = {n.node_id: f"N{i}" for i, n in enumerate(sorted(nodes, key=lambda n: n.node_id))}
    quote = lambda s: str(s).replace('"', "'").replace("\n", "<br/>")
    lines = ["flowchart LR", *(f'  {number[n.node_id]}["{quote(n.name)}"]' for n in sorted(nodes, key=lambda n: n.node_id))]
    return "\n".join([*lines, *(f"  {number[e.from_id]} -->|{quote(e.relationship)}| {number[e.to_id]}" for e in sorted(edges, key=lambda e: e.id))])


FORMATS = {"compact": compact, "table": table, "network": network, "mermaid": to_mermaid}
