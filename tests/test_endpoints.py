from folioscope.operators.endpoints import resolve_ends

NODES = [
    ("system:p:hub", "p", "System", "Hub"), ("interface:p:feed", "p", "Interface", "Feed"), ("process:p:book1:order_entry", "p", "BusinessProcess", "Order Entry"),
    ("field:p:book1:sheet_02:qty", "p", "Field", "qty"), ("field:p:book2:sheet_01:qty", "p", "Field", "qty"), ("data:p:book9:stock", "p", "DataEntity", "Stock"),
    ("x1", "p", "System", "Only One"), ("x2", "p", "Rule", "Twice"), ("x3", "q", "Rule", "Twice"), ("rule_business:p:b:r7", "p", "BusinessRule", "Shared"), ("system:p:s9", "p", "System", "Shared"),
    ("middleware:p:hub", "p", "Middleware", "Hub"), ("x4", None, None, None),
]
CASES = [
    (None, "empty", None), ("  ", "empty", None), ("x1", "exact", "x1"), ("old9", "remap", "x2"), ("INTERFACE:P:FEED", "remap", "interface:p:feed"), ("Only One", "name", "x1"),
    ("p:Rule:Twice", "label_name", "x2"), ("p:System:hub ", "global", "system:p:hub"), ("p:BusinessProcess:ORDER entry", "workbook", "process:p:book1:order_entry"),
    ("p:Field:QTY", "sheet", "field:p:book1:sheet_02:qty"), ("p:DataEntity:stock", "any_scope", "data:p:book9:stock"), ("FEED", "probe", "interface:p:feed"),
    ("Hub", "probe", "system:p:hub"), ("order  entry", "probe_workbook", "process:p:book1:order_entry"), ("z:z:only-one", "last_name", "x1"), ("p:BusinessRule:SHARED", "last_name_label", "rule_business:p:b:r7"),
    ("Twice", "unresolved", None), ("p:Job:nothing", "unresolved", None), ("a:b", "unresolved", None),
]


def test_every_strategy(spark):
    nodes = spark.createDataFrame([(*n, 1) for n in NODES + NODES[:3]], "node_id string, project_id string, label string, name string, target int")
    refs = spark.createDataFrame([(i, r, "p", "book1", "sheet_02") for i, (r, _, _) in enumerate(CASES)] + [(99, "x1", None, None, None), (99, "x1", None, None, None)], "i int, ref string, project_id string, workbook_name string, sheet_name string")
    remap = spark.createDataFrame([("old9", "x2"), ("old8", "gone")], "old_id string, node_id string")
    got = resolve_ends(refs, nodes, remap=remap).collect()
    assert len(got) == len(CASES) + 2
    assert {r.i: (CASES[r.i][0], r.strategy, r.target) for r in got if r.i < 99} == dict(enumerate(CASES))


def test_empty(spark):
    nodes = spark.createDataFrame([], "node_id string, project_id string, label string, name string")
    refs = spark.createDataFrame([(1, "x", "p", None, None)], "i int, ref string, project_id string, workbook_name string, sheet_name string")
    assert [(r.strategy, r.target) for r in resolve_ends(refs, nodes).collect()] == [("unresolved", None)]
    assert resolve_ends(refs.limit(0), nodes).count() == 0
