"""Links between documents: named things, diagrams and workbooks, and layers of a graph's context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import rules
from folioscope.operators.graph import connected, contains_join, name_search
from folioscope.sources import mermaid


def named_links(texts: DataFrame, names: DataFrame, existing: DataFrame, *, kind: str, confidence: float = 0.70) -> DataFrame:
    """(from_id, to_id, relationship, confidence): nodes whose description names another node, unless the edge is there already.

    ``texts``: node_id, description; ``names``: node_id, name; ``existing``: from_id, to_id, relationship. Of nodes with one name the last id is linked.
    """
    last = names.filter("trim(coalesce(name, '')) <> ''").groupBy(F.trim("name").alias("name")).agg(F.max("node_id").alias("to_id"))
    found = contains_join(texts, last, text_key="node_id", text="description", name_key="to_id", name="name")
    new = found.select(F.col("node_id").alias("from_id"), "to_id", F.lit(kind).alias("relationship")).filter("from_id <> to_id")
    return new.join(existing.select("from_id", "to_id", "relationship"), ["from_id", "to_id", "relationship"], "left_anti").withColumn("confidence", F.lit(confidence))


# Words that tell a flowchart, and the weights of a link.
FLOW_WORDS = "フローチャート|flowchart|フロー|flow"
SAME_WORD, ANY_WORD, PER_PART, MOST_PARTS, SHEET, PER_LABEL, MOST_LABELS = 0.7, 0.6, 0.2, 0.5, 0.3, 0.05, 0.4


def diagram_links(diagrams: DataFrame, books: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """(project_id, diagram, book, score): the best workbook of every diagram, ties to the earlier name.

    ``diagrams``: project_id, diagram; ``books``: project_id, book; ``shared``: project_id, diagram, book, labels (labels of the
    diagram that the book's text holds). Pairs come from equal parts of names, from flowchart words on both sides and from shared
    labels, within a project; a pair without any of them scores nothing and is never made.
    """
    parts = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[_\-\s　.]+"), lambda x: x != ""))
    flow = lambda c: F.lower(c).rlike(FLOW_WORDS)
    keys = lambda c: F.explode(F.when(flow(c), F.array_append(parts(c), F.lit("\u0000flow"))).otherwise(parts(c)))
    a = diagrams.select("project_id", "diagram").distinct().select("*", keys("diagram").alias("key"))
    b = books.select("project_id", "book").distinct().select("*", keys("book").alias("key"))
    common = a.join(b, ["project_id", "key"]).groupBy("project_id", "diagram", "book").agg(F.count_if(F.col("key") != "\u0000flow").alias("parts"), F.max(F.col("key") == "\u0000flow").alias("flow"))
    if shared is not None:
        common = common.join(shared, ["project_id", "diagram", "book"], "full_outer")
    else:
        common = common.withColumn("labels", F.lit(0))
    words = F.regexp_extract_all(F.lower("diagram"), F.lit(f"({FLOW_WORDS})"), 1)
    same = F.arrays_overlap(words, F.regexp_extract_all(F.lower("book"), F.lit(f"({FLOW_WORDS})"), 1))
    name = F.when(F.col("flow") & same, SAME_WORD).when(F.col("flow"), ANY_WORD).otherwise(F.least(F.lit(MOST_PARTS), F.coalesce("parts", F.lit(0)) * PER_PART))
    labels = F.when(F.col("labels") > 3, F.least(F.lit(MOST_LABELS), F.col("labels") * PER_LABEL)).otherwise(0.0)
    scored = common.withColumn("score", F.round(F.least(F.lit(1.0), name + F.when(flow("book"), SHEET).otherwise(0.0) + labels), 4)).filter("score > 0")
    best = F.min_by(F.struct("book", "score"), F.struct((-F.col("score")).alias("s"), F.col("book")))
    return scored.groupBy("project_id", "diagram").agg(best.alias("l")).select("project_id", "diagram", "l.book", "l.score")


def diagram_labels(pieces: DataFrame) -> DataFrame:
    """(project_id, diagram, label): labels of more than three characters of the nodes in every diagram's Mermaid text.

    ``pieces``: project_id, diagram, source_file, place, content; the pieces of a file are put together in the order of ``place``. The
    text is that of the fenced blocks, or the whole file if it begins as a flowchart does.
    """
    import pyarrow as pa

    def labels(batches):
        for batch in batches:
            out: list[list] = []
            for text in batch.column(2).to_pylist():
                sources = mermaid.fenced(text) or ([text] if text.lstrip().startswith(("flowchart", "graph ", "%%")) else [])
                out.append(sorted({n["label"] for s in sources for n in mermaid.parse(s).nodes if len(n["label"]) > 3}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.string()))], names=["project_id", "diagram", "labels"])

    piece = F.struct("place", "content")
    files = pieces.filter("content is not null").groupBy("project_id", "diagram", "source_file").agg(F.array_sort(F.collect_set(piece)).alias("p"))
    texts = files.select("project_id", "diagram", F.array_join(F.col("p.content"), "\n").alias("text"))
    return texts.mapInArrow(labels, "project_id string, diagram string, labels array<string>").select("project_id", "diagram", F.explode("labels").alias("label")).distinct()


def shared_labels(labels: DataFrame, texts: DataFrame) -> DataFrame:
    """(project_id, diagram, book, labels): how many labels of a diagram, in any case, the texts of a workbook of its project hold.

    ``labels``: project_id, diagram, label; ``texts``: key (unique), project_id, book, content. All labels of a diagram count.
    """
    found = contains_join(texts, labels.select("label").distinct(), text_key="key", text="content", name_key="label", name="label")
    held = found.join(texts.select("key", "project_id", "book"), "key").select("project_id", "book", "label").distinct()
    return held.join(labels, ["project_id", "label"]).groupBy("project_id", "diagram", "book").agg(F.count("*").alias("labels"))


# Labels of the two layers of a context and how much of each is shown.
BUSINESS = ("System", "Interface", "DataFlow", "BusinessRule", "BusinessProcess", "DataEntity")
IMPLEMENTATION = ("Field", "FieldMapping", "FlowNode", "MappingRule", "APIOperation", "ScriptStep")
LAYER_NODES, LAYER_EDGES = 60, 80


def layered_context(nodes: DataFrame, edges: DataFrame, *, layers: dict[str, Sequence[str]] | None = None, most_nodes: int = LAYER_NODES, most_edges: int = LAYER_EDGES) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of every layer, the surest first, a fixed number of each shown: (layer, node_id, ...), (layer, pos, ...).

    An edge belongs to a layer by the labels of both its ends, whether these are among the nodes shown or not.
    """
    layers = layers or {"business": BUSINESS, "implementation": IMPLEMENTATION}
    kept_nodes, kept_edges = None, None
    for name, labels in layers.items():
        every = nodes.filter(F.col("label").isin(*labels)).groupBy("node_id").agg(F.max("confidence").alias("confidence"))
        n = every.orderBy(F.desc_nulls_last("confidence"), "node_id").limit(most_nodes)
        e = connected(edges, every).orderBy(F.desc_nulls_last("confidence"), "pos").limit(most_edges)
        n, e = n.select(F.lit(name).alias("layer"), "node_id", "confidence"), e.select(F.lit(name).alias("layer"), "pos", "relationship")
        kept_nodes, kept_edges = (n, e) if kept_nodes is None else (kept_nodes.unionByName(n), kept_edges.unionByName(e))
    return kept_nodes, kept_edges


# Of each layer the labels whose names are searched first, those of their neighbours, and all its labels.
LAYER_LABELS = {
    "business": (("System",), ("System", "BusinessProcess", "DataEntity"), BUSINESS),
    "implementation": (("APIOperation", "FlowNode", "MappingRule"), ("Field", "FieldMapping", "MappingRule", "FlowNode", "APIOperation"), IMPLEMENTATION),
}


def _touching(edges: DataFrame, hits: DataFrame, near: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Edges with one end among the ``hits`` (node_id, and the columns ``keep``) and the other among the nodes ``near``."""
    out = None
    for own, other in (("from_id", "to_id"), ("to_id", "from_id")):
        e = edges.select("pos", F.col(own).alias("own_"), F.col(other).alias("other_"))
        part = e.join(hits, F.col("own_") == F.col("node_id")).join(near.select(F.col("node_id").alias("n_")), F.col("other_") == F.col("n_"), "left_semi").select(*keep, "pos")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def _labelled(nodes: DataFrame, labels: Sequence[str]) -> DataFrame:
    return nodes.filter(F.col("label").isin(*labels)).select("node_id").distinct()


def layers_by_terms(nodes: DataFrame, edges: DataFrame, terms: DataFrame, *, term: str) -> DataFrame:
    """(layer, term, way, pos): edges around the nodes that a term names.

    First by the names of a layer's main labels to neighbours of the labels that go with them (``names``); only for terms
    without any such edge by the names of all its labels to any neighbour (``keywords``). Nothing is cut: a caller shows as
    many as it likes.
    """
    held = name_search(nodes.select("node_id", "name"), terms, term=term, per_term=None).select(term, "node_id").distinct()
    out = None
    for layer, (main, near, labels) in LAYER_LABELS.items():
        first = _touching(edges, held.join(_labelled(nodes, main), "node_id", "left_semi"), _labelled(nodes, near), [term])
        rest = held.join(first.select(term).distinct(), term, "left_anti").join(_labelled(nodes, labels), "node_id", "left_semi")
        more = _touching(edges, rest, nodes.select("node_id").distinct(), [term])
        both = first.withColumn("way", F.lit("names")).unionByName(more.withColumn("way", F.lit("keywords"))).withColumn("layer", F.lit(layer))
        out = both if out is None else out.unionByName(both)
    return out


PAGE = ("project_id", "workbook_name", "sheet_name")


def layers_by_sheets(nodes: DataFrame, edges: DataFrame, terms: DataFrame, *, term: str) -> DataFrame:
    """(layer, pos): edges between the sheet nodes of the sheets that hold a node named by a term and nodes of the layer's labels."""
    held = name_search(nodes.select("node_id", "name"), terms, term=term, per_term=None).select(F.col("node_id").alias("h_"), F.col("name").alias("n_")).distinct()
    pages = nodes.join(held, (F.col("node_id") == F.col("h_")) & (F.col("name") == F.col("n_")), "left_semi").select(*PAGE).distinct()
    sheets = nodes.filter("label = 'Sheet'").join(pages, list(PAGE), "left_semi").select("node_id").distinct()
    out = None
    for layer, (_, _, labels) in LAYER_LABELS.items():
        part = _touching(edges, sheets, _labelled(nodes, labels), []).withColumn("layer", F.lit(layer))
        out = part if out is None else out.unionByName(part)
    return out


def guidance_hints(nodes: DataFrame, edges: DataFrame, names: DataFrame, *, key: str, name: str) -> DataFrame:
    """(key, sheets, quality): how many sheets hold a node that a name names or one next to it, and how good a hint they are."""
    found = contains_join(nodes.select("name").filter("name is not null").distinct(), names, text_key="name", text="name", name_key=key, name=name)
    hits = nodes.select("node_id", "name").join(found, "name").select(key, "node_id").distinct()
    near = [edges.select(F.col(a).alias("node_id"), F.col(b).alias("b_")).join(hits, "node_id").select(key, F.col("b_").alias("node_id")) for a, b in (("from_id", "to_id"), ("to_id", "from_id"))]
    placed = nodes.filter("coalesce(workbook_name, '') <> '' and coalesce(sheet_name, '') <> ''").select("node_id", F.struct(*PAGE).alias("page")).distinct()
    counts = hits.unionByName(near[0]).unionByName(near[1]).distinct().join(placed, "node_id").select(key, "page").distinct().groupBy(key).agg(F.count("*").alias("n_"))
    every = placed.agg(F.count_distinct("page").alias("every_"))  # one row
    rows = names.select(key).distinct().join(counts, key, "left").crossJoin(F.broadcast(every))
    return rows.select(key, F.coalesce("n_", F.lit(0)).cast("bigint").alias("sheets"), rules.hint_quality(F.col("n_"), F.col("every_")).alias("quality"))


def snapshot(tables: dict[str, DataFrame], by: str = "project_id") -> DataFrame:
    """(table, key, rows, columns): counts per project and the schema of every table, to compare with later."""
    out = None
    for name, df in tables.items():
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        part = df.groupBy(F.coalesce(F.col(by).cast("string"), F.lit("")).alias("key")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "key", "rows", F.lit(schema).alias("columns"))
        out = part if out is None else out.unionByName(part)
    return out


def changes(before: DataFrame, after: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Differences of two snapshots: what is new or gone, counts beyond the tolerance, other columns."""
    b = before.select("table", "key", F.col("rows").alias("rows_before"), F.col("columns").alias("columns_before"))
    both = after.join(b, ["table", "key"], "full_outer")
    moved = F.abs(F.col("rows") - F.col("rows_before")) > F.col("rows_before") * tolerance
    what = F.when(F.col("rows_before").isNull(), "new").when(F.col("rows").isNull(), "gone").when(F.col("columns") != F.col("columns_before"), "columns").when(moved, "rows")
    return both.withColumn("change", what).filter("change is not null").select("table", "key", "change", "rows_before", "rows")


