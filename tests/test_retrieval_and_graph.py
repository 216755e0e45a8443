import itertools

import pytest
from pyspark.sql import functions as F

from folioscope import cli
from folioscope.operators import graph as gr
from folioscope.operators import retrieval as rt
from folioscope.plans import display
from folioscope.plans.experiments import graph_sheets_near
from folioscope.plans.retriever import Retriever, index_chunks
from folioscope.plans.session import Session


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_fusion_invariants(spark):
    v = spark.createDataFrame([("v1", 0.9), ("v2", 0.7), ("v3", 0.5)], "id string, score double")
    k = spark.createDataFrame([("k1", 0.8), ("v1", 0.6), ("v3", 1.0)], "id string, score double")
    assert rows(rt.fuse(v, k, key="id"), "id", "score", "source", "in_both") == [("k1", 0.72, "keyword", False), ("v1", 0.9, "vector", True), ("v2", 0.7, "vector", False), ("v3", 0.9, "keyword", True)]
    assert [r.id for r in rt.fuse(v, k, key="id", k=2).collect()] == ["v1", "v3"]
    g = spark.createDataFrame([("a", 0.99), ("b", 0.5)], "id string, score double")
    s = spark.createDataFrame([("b", 0.9), ("c", 0.1)], "id string, score double")
    assert rows(rt.fuse_guided(g, s, key="id"), "id", "score", "source") == [("a", 1.0, "guided"), ("b", 0.5, "guided"), ("c", 0.1, "standard")]


def test_nearest(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, None), (5, [1.0])], "id int, embedding array<float>")
    got = rt.nearest(df, [1.0, 0.0], 2, key="id")
    assert rows(got, "id", "score") == [(1, 1.0), (3, 1.0)]
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()
    q = df.filter("id < 3").withColumnRenamed("id", "q")
    assert rows(rt.nearest_join(df, q, 1, key="id", query_key="q"), "q", "id", "rank") == [(1, 1, 1), (2, 2, 1)]


def test_nearest_of_many_queries(spark):
    """In blocks of a few queries, with ties, copies and unfit vectors, equal to brute force."""
    import random

    rng = random.Random(5)
    data = [(i, [float(rng.randint(-1, 1)) for _ in range(4)]) for i in range(300)] + [(900, None), (901, [1.0]), (902, [float("nan")] * 4), (903, [1.0, None, 0.0, 0.0])]
    queries = [(f"q{i}", [float(rng.randint(-1, 1)) for _ in range(4)]) for i in range(25)] + [("n", None), ("s", [0.0] * 3)]
    df = spark.createDataFrame(data, "id int, embedding array<float>").repartition(3)
    q = spark.createDataFrame(queries, "q string, embedding array<float>")
    got = rows(rt.nearest_join(df, q, 4, key="id", query_key="q", query_numbers=30), "q", "rank", "id", "distance")
    true = []
    for name, v in queries[:25]:
        best = sorted((sum((a - b) ** 2 for a, b in zip(x, v)), i) for i, x in data[:300])[:4]
        true += [(name, n + 1, i, d) for n, (d, i) in enumerate(best)]
    assert got == sorted(true)
    assert rt.nearest_join(df.limit(0), q, 4, key="id", query_key="q").count() == rt.nearest_join(df, q.limit(0), 4, key="id", query_key="q").count() == 0


def test_many_terms_are_no_product(spark):
    nodes = spark.createDataFrame([(f"n{i}", f"Stock Feed {i % 7} x") for i in range(60)] + [("z", None)], "node_id string, name string")
    terms = spark.createDataFrame([(t,) for t in ("stock", "Feed 3", "feed 3", " ", "zzz", "", "7")], "term string")
    few, many = (rows(gr.name_search(nodes, terms, term="term", per_term=None, few_terms=n), "term", "node_id", "name") for n in (1000, 2))
    assert few == many and len(few) == 60 * 2 + 2 * 9 - 2 * (60 % 7 <= 3)


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    import types

    import pytest

    from folioscope.runtime import shared_dir

    def session(master, folder=None):
        conf = types.SimpleNamespace(get=lambda k, d=None: folder)
        return types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master, getConf=lambda: conf))

    assert shared_dir(session("local[4]")).startswith("file://") and shared_dir(session("spark://x:1", "s3a://b/c/")) == "s3a://b/c"
    with pytest.raises(ValueError):
        shared_dir(session("spark://x:1"))


def test_nearest_keys_agrees(spark):
    import random

    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(6)]) for i in range(500)] + [(900, None), (901, [1.0]), (902, [float("nan")] * 6), (903, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id int, embedding array<float>").repartition(5)
    q = [1.0, 0.0, -1.0, 0.0, 2.0, 0.0]
    clean = df.filter("id < 900")
    for k in (1, 7, 600):
        assert rows_of(rt.nearest_keys(df, q, k, key="id")) == rows_of(rt.nearest(clean, q, k, key="id").select("id", "distance", "score"))
    assert rt.nearest_keys(df.limit(0), q, 3, key="id").count() == 0


def rows_of(df):
    return [tuple(r) for r in df.orderBy("distance", "id").collect()]


def test_plans_keep_to_their_shape(spark, tmp_path):
    """What reaches the scan, what is broadcast, what stays out of Python."""
    spark.createDataFrame([(1, "a", [1.0], "p")], "id int, text string, embedding array<float>, project string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    p = plan(rt.nearest(df, [1.0], 3, key="id", where=F.col("project") == "p").select("id", "score"))
    assert "TakeOrderedAndProject" in p and "EqualTo(project,p)" in p and "text" not in p and "Exchange" not in p
    p = plan(rt.keyword_search(df.select("id", "text"), ["a"], 3, key="id"))
    assert "Python" not in p and "embedding" not in p and "TakeOrderedAndProject" in p
    p = plan(gr.latest(df.select("id", "text"), "id", ("text",)))
    assert p.count("Exchange") == 1 and "Window" not in p


def test_keywords_and_rerank(spark):
    df = spark.createDataFrame([(1, "order status"), (2, "Order"), (3, None), (4, "order order stock")], "id int, text string")
    assert rows(rt.keyword_search(df, ["order", "stock"], 5, key="id"), "id", "score") == [(1, 0.5), (4, 1.0)]
    assert rt.keyword_search(df, [], 5, key="id").count() == 0
    hits = rt.keyword_search(df, ["order"], 5, key="id")
    assert rows(rt.keyword_boost(hits, ["STATUS"] * 9), "id", "score") == [(1, 1.0), (4, 1.0)]
    ranked = rt.rerank(hits, rt.lexical_model("stock"), key="id", text="text", k=2)
    assert [r.id for r in ranked.collect()] == [4, 1]
    none = rt.rerank(hits, lambda t: F.lit(None).cast("double"), key="id", text="text")
    assert [r.id for r in none.collect()] == [1, 4]


def test_provenance_tiers(spark):
    chunks = spark.createDataFrame([(f"c{i}", "p", "b1", "s1" if i < 5 else "s2") for i in range(8)] + [("x", "q", "b1", "s1")], "chunk_id string, project_id string, workbook_name string, sheet_name string")
    cand = spark.createDataFrame([("n1", "p", "b1", "s1", 0.6), ("n2", "p", "b1", "s9", 0.6), ("n3", "p", "b9", "s1", 0.6), ("n4", "p", "", "s1", 0.6)], "node string, project_id string, workbook_name string, sheet_name string, score double")
    assert rows(rt.provenance(cand, chunks, candidate="node"), "node", "chunk_id", "tier", "score") == [("n1", f"c{i}", 1, 0.6) for i in range(3)] + [("n2", f"c{i}", 2, 0.42) for i in range(3)]


def test_entities(spark):
    e = spark.createDataFrame([("API", 0.8, 1, "query"), ("api", 0.9, 2, "chunk"), ("Api", 0.9, 3, "query"), ("x", 0.5, 4, "rewrite")], "text string, confidence double, place int, source string")
    best = rt.best_entities(e)
    assert rows(best, "text", "place") == [("api", 2), ("x", 4)] and [r.text for r in rt.order_entities(best).collect()] == ["api", "x"]


EDGES = [("e1", "a", "b", "R"), ("e2", "b", "c", "R"), ("e3", "c", "a", "R"), ("e4", "a", "a", "R"), ("e5", "b", "d", "S"), ("e6", None, "d", "R"), ("e7", "a", "zz", "R")]


def graph(spark):
    edges = spark.createDataFrame(EDGES, "id string, from_id string, to_id string, relationship string")
    nodes = spark.createDataFrame([(i, n, n.upper(), "System", "verified") for i, n in enumerate("abcde")], "pos int, node_id string, name string, label string, review_status string")
    return nodes, edges


def test_checks(spark):
    nodes, edges = graph(spark)
    assert rows(gr.dangling(edges, nodes), "id") == [("e6",), ("e7",)]
    assert rows(gr.connected(edges, nodes), "id") == [(f"e{i}",) for i in range(1, 6)]
    assert rows(gr.isolated(nodes, edges), "node_id") == [("e",)]
    assert gr.connected(edges, nodes.limit(0)).count() == 0 and gr.dangling(edges.limit(0), nodes).count() == 0


def test_traversal_walks_no_edge_twice(spark):
    nodes, edges = graph(spark)
    seeds = nodes.filter("node_id = 'a'")
    assert rows(gr.expand_one(seeds, edges, seed="node_id", kinds=["R"]), "found", "edge") == [("a", "e4"), ("b", "e1"), ("c", "e3"), ("zz", "e7")]
    assert {(r.found, r.edges) for r in gr.expand_two(seeds, edges, seed="node_id", kinds=["R"], per_seed=50).collect()} == {("c", "e1/e2"), ("b", "e3/e2"), ("b", "e4/e1"), ("c", "e4/e3"), ("zz", "e4/e7")}
    links = {i: (a, b) for i, a, b, r in EDGES if a and r == "R"}
    want = sorted((n, p) for n in (1, 2, 3) for p in itertools.permutations(links, n) if links[p[0]][0] == "a" and all(links[x][1] == links[y][0] for x, y in zip(p, p[1:])))
    got = gr.walks(seeds, edges.filter("relationship = 'R'"), seed="node_id", depth=3)
    assert sorted((r.length, tuple(r.walked)) for r in got.collect()) == want
    assert rows(gr.reachable(seeds, edges, seed="node_id"), "found", "steps") == [("b", 1), ("c", 2), ("d", 2), ("zz", 1)]


def test_reachable_loses_no_far_node(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(22)], "from_id string, to_id string").coalesce(1)
    seeds = spark.createDataFrame([("n0",)], "node_id string")
    assert sorted(r.steps for r in gr.reachable(seeds, edges, seed="node_id").collect()) == list(range(1, 23))
    assert gr.reachable(seeds, edges.filter("from_id < 'n11'"), seed="node_id", most_steps=2).count() == 2
    with pytest.raises(ValueError):
        gr.reachable(seeds, edges, seed="node_id", most_steps=3)


def test_sheets_near_takes_every_named_node(spark, tmp_path):
    n = [(f"n{i:03}", "Field", f"stock {i}") for i in range(60)] + [(f"s{i:03}", "Sheet", "") for i in range(60)]
    spark.createDataFrame(n, "node_id string, label string, name string").write.parquet(str(tmp_path / "graph_nodes.parquet"))
    spark.createDataFrame([(f"e{i}", f"n{i:03}", f"s{i:03}", "HAS_FIELD") for i in range(60)], "id string, from_id string, to_id string, relationship string").write.parquet(str(tmp_path / "graph_edges.parquet"))
    assert rows(graph_sheets_near(spark, str(tmp_path)), "sheet", "steps") == [(f"s{i:03}", 1) for i in range(60)]


def test_merge_and_upsert(spark):
    n = spark.createDataFrame([("k", 1, 0.5, "A", ""), ("k", 2, 0.9, "B", None), ("k", 3, 0.9, "C", "x"), ("k", 4, None, "A", "y"), ("m", 5, None, None, None)], "key string, pos int, confidence double, name string, layer string")
    got = {r.key: r for r in gr.merge_entities(n, "key", fields=("name", "layer")).collect()}
    assert (got["k"].name, got["k"].layer, got["k"].confidence, got["k"].aliases, got["k"].rows) == ("B", "x", 0.9, ["A", "C"], 4) and got["m"].name is None
    assert rows(gr.latest(n, "key", ("pos",)), "key", "pos") == [("k", 4), ("m", 5)] and rows(gr.first_of(n, "key", "pos"), "key", "pos") == [("k", 1), ("m", 5)]


def test_resolve_keeps_every_reference(spark):
    refs = spark.createDataFrame([("a",), ("A",), ("zz",), (None,)], "ref string")
    t = lambda *p: spark.createDataFrame(list(p), "key string, target string")
    assert sorted((r.ref or "", r.target, r.strategy) for r in gr.resolve(refs, "ref", [("exact", t(("a", "a"))), ("loose", t(("A", "a"), ("a", "other")))]).collect()) == [("", None, "unresolved"), ("A", "a", "loose"), ("a", "a", "exact"), ("zz", None, "unresolved")]


def test_numbers_are_consecutive_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("p")).repartition(7)
    assert [r.number for r in gr.numbered(df, "p").orderBy("p").collect()] == list(range(1, 1001))


@pytest.mark.parametrize("way", ["automaton", "grams"])
def test_contains_join(spark, monkeypatch, way):
    if way == "grams":
        monkeypatch.setattr(gr, "MAX_NAMES", 0)
    texts = spark.createDataFrame([(1, "the Order Hub here"), (2, "在庫の元帳"), (3, None), (4, ""), (5, "a hub"), (5, "a hub")], "k int, t string")
    names = spark.createDataFrame([(10, "order hub"), (11, "元帳"), (12, ""), (13, None), (14, "HUB"), (15, "在"), (16, "order hub")], "n int, name string")
    assert rows(gr.contains_join(texts, names, text_key="k", text="t", name_key="n", name="name"), "k", "n") == [(1, 10), (1, 14), (1, 16), (2, 11), (2, 15), (5, 14)]


def test_limit_per_group_with_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"), "id")
    got = gr.top_n_per(df, ["g"], [F.col("id")], 3, "id").filter("g = 'hot'")
    assert rows(got, "id") == [(0,), (3,), (6,)]


def test_statements_and_formats(spark):
    n = spark.createDataFrame([("i'1", "My Label", "a\\b;\nc", None), ("i2", None, None, "p")], "node_id string, label string, name string, project_id string")
    assert rows(gr.node_statements(n), "statement") == [("MERGE (n:Entity {id: 'i2'}) SET n.project_id = 'p';",), ("MERGE (n:My_Label {id: 'i\\'1'}) SET n.name = 'a\\\\b； c';",)]
    nodes, edges = graph(spark)
    shown = display.limited(nodes, edges)
    assert "A [System] -R-> B [System]" in display.compact(*shown) and display.to_mermaid(*shown).startswith("flowchart LR\n  N0[\"A\"]")
    assert all(f(*shown) for f in display.FORMATS.values())


def test_retriever_keeps_to_its_project(spark):
    chunks = [(f"c{i}", f"{w} number {i}", f"p{i % 2}", "b", "s") for i, w in enumerate(["order status", "stock feed", "Warehouse 在庫", "order hub"] * 3)]
    df = index_chunks(spark.createDataFrame(chunks, "chunk_id string, content string, project_id string, workbook_name string, sheet_name string").withColumn("embedding_text", F.col("content")))
    nodes = spark.createDataFrame([("n1", "Order hub", "p1", "b", "s"), ("n2", "x", "p1", "b", "s")], "node_id string, name string, project_id string, workbook_name string, sheet_name string")
    edges = spark.createDataFrame([("e1", "n1", "n2", "HAS_SHEET")], "id string, from_id string, to_id string, relationship string")
    r = Retriever(spark, df, nodes, edges)
    for kw in ({}, {"graph": True}, {"rerank": True}):
        hits, trace = r.retrieve("order  hub", project="p1", k=4, **kw)
        got = hits.collect()
        assert 0 < len(got) <= 4 and {int(h.chunk_id[1:]) % 2 for h in got} == {1} and "fuse" in trace.stages


def test_copies_of_a_chunk_use_one_place(spark):
    chunks = [("c0", "order hub", [1.0, 0.0])] * 30 + [(f"c{i}", f"order number {i}", [1.0, i / 10]) for i in range(1, 7)]
    df = spark.createDataFrame(chunks, "chunk_id string, content string, embedding array<double>").withColumns({c: F.lit("p") for c in ("project_id", "workbook_name", "sheet_name")})
    for parts in (1, 5):
        r = Retriever(spark, df.repartition(parts), embed=lambda texts: [[1.0, 0.0]] * len(texts))
        assert [h.chunk_id for h in r.retrieve("order hub", k=5)[0].collect()] == ["c0", "c1", "c2", "c3", "c4"]
        near = rt.nearest_keys(df.repartition(parts), [1.0, 0.0], 3, key="chunk_id", once=True).collect()
        assert [(h.chunk_id, round(h.distance, 4)) for h in near] == [("c0", 0.0), ("c1", 0.01), ("c2", 0.04)]
        assert [h.chunk_id for h in rt.keyword_search(df.repartition(parts), ["order"], 3, key="chunk_id", text="content", once=True).collect()] == ["c0", "c1", "c2"]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "_session", lambda: spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_text("# A\n\n## Orders\n\n" + "The order hub keeps every order. " * 12)
    src, parsed, out = str(tmp_path / "in"), str(tmp_path / "parsed"), str(tmp_path / "kb")
    cli.main(["scan", src, "--project", "p"])
    cli.main(["parse", src, parsed, "--project", "p"])
    cli.main(["build", parsed, out, "--project", "p"])
    cli.main(["build", parsed, out, "--project", "p", "--replace"])
    cli.main(["ask", out, "order hub", "--project", "p", "--answer"])
    assert "1 chunks" in (said := capsys.readouterr().out) and "The order hub keeps every order." in said
    with pytest.raises(SystemExit):
        cli.main(["ask", out, "q", "--project", "p", "--top", "99"])


def test_session(spark):
    chunks = [(f"c{i}", f"{w} number {i}. More of it.", "p1", "b", "s") for i, w in enumerate(["order status", "stock feed", "order hub"])]
    df = index_chunks(spark.createDataFrame(chunks, "chunk_id string, content string, project_id string, workbook_name string, sheet_name string").withColumn("embedding_text", F.col("content"))).cache()
    nodes = spark.createDataFrame([("n1", "Order hub", "System", "p1", "b", "s")], "node_id string, name string, label string, project_id string, workbook_name string, sheet_name string")
    edges = spark.createDataFrame([], "id string, from_id string, to_id string, relationship string")
    s = Session(Retriever(spark, df, nodes, edges), project="p1")
    assert s.line("") == "" and s.line("/nope").startswith("no command") and s.line("/last") == "no question yet"
    assert s.line("/top 99") == "top 20" and s.line("/top x") == "a number" and s.line("/top 2") == "top 2" and s.line("/mode x").startswith("modes")
    assert len(s.line("order hub").splitlines()) == 2
    assert s.line("/mode answer") == "mode answer" and "More of it." in s.line("order hub").split("\n\n")[0]
    s.line("/mode graph"), s.line("/format table")
    assert "Order hub" in s.line("/last") and s.line("/history").count("order hub") == 3 and "fuse" in s.line("/trace") and s.line("/stats").startswith("3 questions")
    assert "/mode" in s.line("/help") and s.line("/rerank on") == "rerank on" and s.line("/project") == "project all"
