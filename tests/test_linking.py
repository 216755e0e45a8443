import json

import pytest
from pyspark.sql import functions as F

from folioscope.functions import layout
from folioscope.operators import extraction as ex
from folioscope.operators import linking
from folioscope.plans import links


def test_entities(spark):
    df = spark.createDataFrame([(1, "N101 の COMPANY_CODE を DataSpider へ マッピング 変換処理"), (2, None), (3, "")], "k int, t string")
    got = {(r.text, r.type, r.confidence) for r in ex.entities(df, key="k", text="t", source="query").collect()}
    assert {("N101", "id_code", 0.9), ("COMPANY_CODE", "field", 0.8), ("DataSpider", "api", 0.7), ("マッピング", "mapping", 0.75), ("変換処理", "mapping", 0.7)} <= got


@pytest.mark.parametrize(("text", "value"), [
    ('```json\n{"nodes": [{"id": "a"}]}\n```', {"nodes": [{"id": "a"}]}), ('{"nodes": [{"id": "a"}, {"id": "b', {"nodes": [{"id": "a"}]}), ('[{"id": "a}"}, {"id"', [{"id": "a}"}]),
    ("Here: [1, 2] done", [1, 2]), ("nothing", None), ("", None), ('{"a": ', None),
])
def test_repaired_json(text, value):
    assert ex.repaired_json(text) == value


def test_two_pass_extraction_asks_once(spark, tmp_path):
    log = str(tmp_path / "asked")

    def model(prompt):
        with open(log, "a") as f:
            f.write("x")
        if prompt.startswith("NODES"):
            return '```json\n{"nodes": [{"id": "a", "entity_type": "System", "name": "A", "confidence": 7}, {"id": "b", "type": "Field", "confidence": "x"}, {"id": "cut'
        ids = json.loads(prompt.split("\n")[1])
        return json.dumps({"edges": [{"from": ids[0], "to_id": ids[1], "type": "HAS_FIELD"}]})

    docs = spark.createDataFrame([("d", "text " * 40), ("short", "x"), ("n", None)], "k string, t string").coalesce(1)
    nodes, edges = ex.extract_graph(docs, model, key="k", text="t")
    assert sorted((r.id, r.entity_type, r.confidence) for r in nodes.collect()) == [("a", "System", 1.0), ("b", "Field", 0.5)]
    assert [(r.doc_key, r.start_id, r.end_id, r.type) for r in edges.collect()] == [("d", "a", "b", "HAS_FIELD")] and nodes.count() == 2
    assert len(open(log).read()) == 2


def test_keyword_graph(spark):
    c = spark.createDataFrame([("p", "S1", ["SAP", "sap"]), ("p", "S1", ["SAP"]), ("p", "S2", []), (None, "S3", ["X"])], "project_id string, sheet string, systems array<string>")
    nodes, edges = ex.keyword_graph(c, sheet=F.col("sheet"))
    assert sorted(r.node_id for r in nodes.collect()) == ["sheet:p:s1", "sheet:p:s2", "system:p:sap"]
    assert [(r.from_id, r.to_id) for r in edges.collect()] == [("sheet:p:s1", "system:p:sap")]


def test_named_links(spark):
    t = spark.createDataFrame([("f1", "calls Get Order now"), ("f2", "nothing"), ("a2", "get order"), ("f3", None)], "node_id string, description string")
    n = spark.createDataFrame([("a1", "get order"), ("a2", "Get Order "), ("a3", " "), ("a4", None)], "node_id string, name string")
    old = spark.createDataFrame([("f9", "a2", "CALLS_API")], "from_id string, to_id string, relationship string")
    got = linking.named_links(t, n, old, kind="CALLS_API").collect()
    assert sorted((r.from_id, r.to_id) for r in got) == [("a2", "a1"), ("f1", "a1"), ("f1", "a2")]
    old = spark.createDataFrame([("f1", "a1", "CALLS_API")], "from_id string, to_id string, relationship string")
    assert ("f1", "a1") not in {(r.from_id, r.to_id) for r in linking.named_links(t, n, old, kind="CALLS_API").collect()}


def test_diagram_links(spark):
    d = spark.createDataFrame([("p", "order_flowchart"), ("p", "stock_in"), ("p", "zzz"), ("q", "order_flowchart")], "project_id string, diagram string")
    b = spark.createDataFrame([("p", "order_book"), ("p", "受注フローチャート"), ("p", "the flowchart"), ("p", "stock_out")], "project_id string, book string")
    got = {(r.project_id, r.diagram): (r.book, r.score) for r in linking.diagram_links(d, b).collect()}
    assert got == {("p", "order_flowchart"): ("the flowchart", 1.0), ("p", "stock_in"): ("stock_out", 0.2)}
    shared = spark.createDataFrame([("p", "zzz", "order_book", 5), ("p", "zzz", "stock_out", 3)], "project_id string, diagram string, book string, labels int")
    assert {(r.diagram, r.book, r.score) for r in linking.diagram_links(d, b, shared).collect()} >= {("zzz", "order_book", 0.25)}


def test_diagrams_are_linked_by_shared_labels(spark, tmp_path):
    source = ["# zzz\n```mermaid\nflowchart TD", "A[Check stock] --> B{Stock left?}\nB -->|no| C[Order more]", "C --> D[Send order]\nD --> E[End]\n```"]
    made = [(i, "p", "mermaid/zzz.mmd", "mermaid", "", i, s) for i, s in enumerate(source)] + [(9, "p", "mermaid/yyy.mmd", "mermaid", "", 0, "prose about Check stock [not a node]")]
    made += [(10, "p", "x", "excel", "book_one.xlsx", 0, "CHECK STOCK, then: stock left?"), (11, "p", "x", "excel", "book_one.xlsx", 1, "order more; send order"), (12, "p", "x", "excel", "book_two.xlsx", 0, "check stock, send order, order more"), (13, "q", "x", "excel", "book_q.xlsx", 0, "check stock, stock left? order more, send order")]
    spark.createDataFrame(made, "pos long, project_id string, source_file string, source_type string, workbook_name string, chunk_index int, content string").write.parquet(str(tmp_path / "chunks.parquet"))
    assert [(r.project_id, r.diagram, r.book, r.score) for r in links.link_diagrams(spark, str(tmp_path)).collect()] == [("p", "zzz", "book_one.xlsx", 0.2)]


def test_layer_edges_reach_beyond_the_nodes_shown(spark):
    n = spark.createDataFrame([("a", "System", 0.9), ("b", "Interface", 0.8), ("c", "DataFlow", 0.1), ("d", "DataEntity", None), ("f", "Field", 1.0)], "node_id string, label string, confidence double")
    e = spark.createDataFrame([(1, "c", "d", 0.9), (2, "a", "c", 0.5), (3, "a", "b", 0.1), (4, "a", "f", 1.0), (5, "a", "gone", 1.0)], "pos long, from_id string, to_id string, confidence double").withColumn("relationship", F.lit("USES"))
    nodes, edges = linking.layered_context(n, e, layers={"business": linking.BUSINESS}, most_nodes=2)
    assert [r.node_id for r in nodes.collect()] == ["a", "b"]
    assert sorted(r.pos for r in edges.collect()) == [1, 2, 3]
    assert sorted(r.pos for r in linking.layered_context(n, e, layers={"business": linking.BUSINESS}, most_nodes=2, most_edges=2)[1].collect()) == [1, 2]


def test_snapshot_changes(spark):
    a = spark.createDataFrame([("p", 1), ("p", 2), ("q", 3)], "project_id string, v int")
    before = linking.snapshot({"t": a})
    assert linking.changes(before, linking.snapshot({"t": a})).count() == 0
    after = linking.snapshot({"t": a.filter("project_id = 'p' and v = 1").unionByName(spark.createDataFrame([("r", 1)], a.schema))})
    assert {(r.key, r.change) for r in linking.changes(before, after).collect()} == {("p", "rows"), ("q", "gone"), ("r", "new")}
    assert {r.change for r in linking.changes(before, linking.snapshot({"t": a.withColumn("x", F.lit(1))})).collect()} == {"columns"}


def test_layout(spark):
    df = spark.createDataFrame([(5, 10, 1, 100.0), (30, 200, 2, 1500.0), (200, 9, 1, 4000.0)], "c int, r int, p int, w double")
    got = df.select(layout.paper(F.col("c"), F.col("r"))["width_mm"].alias("mm"), layout.strategy(F.col("c"), F.col("r"), F.col("p")).alias("s"), layout.resolution(F.col("w"), wide=1000, extreme=3000, default=150, wide_dpi=120, extreme_dpi=90).alias("dpi")).collect()
    assert [tuple(r) for r in got] == [(297, "small_sheet", 150), (841, "multi_page", 120), (3000, "single_page", 90)]
    t = spark.range(1).select(F.inline(layout.tiles(F.lit(3200), F.lit(100)))).collect()
    assert [(r.name, r.left, r.right) for r in t] == [("tile_r00_c00", 0, 3000), ("tile_r00_c01", 2700, 3200)]
    assert spark.range(1).select(layout.model_cost(F.lit(10), 2000, 0.003).alias("x")).first().x == 0.06
