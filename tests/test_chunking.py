import random

from pyspark.sql import functions as F

from folioscope.operators import chunking as ch
from folioscope.operators.stats import upper_median
from folioscope.sources import mermaid

DOC = """# Title

**Author:** x

## One

First paragraph of one.

| a | b |
|---|---|
| 1 | 2 |

## Ver 1.2 変更

- changed

## Two

```
## not a heading
```

### Field (`AB1234567`)
type: CHAR
| in | field |

> quote
"""


def test_blocks():
    assert [k for k, _ in ch.blocks(DOC)] == ["title", "meta", "section", "text", "table", "version", "section", "code", "field"]
    assert ch.blocks("```\nopen\nto the end") == [("code", "```\nopen\nto the end")]
    assert ch.blocks("") == []


def random_document(rng):
    parts = []
    for _ in range(rng.randint(1, 40)):
        kind = rng.choice(["# T", "## S", "### F", "p", "p", "table", "code", "long"])
        words = " ".join(rng.choices(["alpha", "beta", "gamma", "受注"], k=rng.randint(3, 60)))
        if kind == "table":
            parts.append("\n".join(f"| {i} | {words[:30]} |" for i in range(rng.randint(1, 40))))
        elif kind == "code":
            parts.append(f"```\n{words}\n```")
        elif kind == "long":
            parts.append("\n".join([words] * rng.randint(1, 60)))
        else:
            parts.append(words if kind == "p" else f"{kind} {words[:20]}")
    return "\n\n".join(parts)


def test_chunks_keep_their_limits():
    rng = random.Random(5)
    for _ in range(150):
        doc = random_document(rng)
        for c in ch.semantic_chunks(doc, 600, 20, 300):
            assert len(c) >= 20 and (len(c) <= 660 or max(map(len, c.split("\n"))) > 200)  # a repeated heading comes on top
        for c in ch.fixed_chunks(doc, 500, 20):
            assert len(c) >= 20
        assert ch.semantic_chunks(doc, 600, 20, 300) == ch.semantic_chunks(doc, 600, 20, 300)


def test_header_is_repeated_when_a_section_goes_on():
    doc = "## Head\n\n" + "\n\n".join(f"paragraph {i} " + "x" * 120 for i in range(12))
    chunks = ch.semantic_chunks(doc, 1000, 20, 400)
    assert len(chunks) > 2 and all(c.startswith("## Head") for c in chunks)


def test_short_document_stays_whole_or_goes():
    assert ch.semantic_chunks("x" * 150) == ["x" * 150] and ch.semantic_chunks("short") == []


SOURCE = """flowchart TD
  subgraph M1["Intake"]
    S(["Start"]) --> C{"Valid?"}
    C -->|Yes| P["Store<br/>order"]
  end
  C -. "No" .-> A1["Note"]
  P --> Q[[Sub]]
"""


def test_mermaid():
    d = mermaid.parse(SOURCE)
    assert {n["id"]: n["type"] for n in d.nodes} == {"S": "terminal", "C": "decision", "P": "process", "A1": "annotation", "Q": "subprocess"}
    assert [(e["source"], e["target"], e["label"]) for e in d.edges] == [("S", "C", ""), ("C", "P", "Yes"), ("C", "A1", "No"), ("P", "Q", "")]
    assert d.subgraphs == [{"id": "M1", "title": "Intake", "nodes": ["S", "C", "P"]}] and d.nodes[2]["label"] == "Store\norder"
    nodes, edges = mermaid.to_graph(d, "p")
    assert sum(e["type"] == "CONTAINS_STEP" for e in edges) == 3 and sum(e["type"] == "BRANCHES_TO" for e in edges) == 2 and nodes[0]["entity_type"] == "FunctionModule"
    md = mermaid.to_markdown("flow", d, SOURCE)
    parts = ch.mermaid_chunks(md)
    assert [p[0] for p in parts] == ["overview", "module", "node_table", "edge_table", "decision", "business_flow"]
    assert not any("flowchart TD" in t for _, t in parts)
    assert mermaid.fenced(md) == [SOURCE.strip()] and mermaid.fenced("```mermaid\nopen") == []


def test_on_tables(spark):
    docs = spark.createDataFrame([("a", DOC, "markdown"), ("b", None, "markdown"), ("c", "pixels " * 3, "images"), ("d", mermaid.to_markdown("f", mermaid.parse(SOURCE), SOURCE), "mermaid")], "k string, body string, kind string")
    cut = ch.chunk_documents(docs.withColumn("strategy", ch.strategy(F.col("kind"))), key="k", body="body", strategy="strategy", least=10)
    rows = cut.collect()
    assert {r.key for r in rows} == {"a", "c", "d"} and all(r.content for r in rows)
    d = ch.described(cut, source_type=F.lit("md"), document=F.col("key"), sheet_name=F.lit("")).collect()
    assert len({r.chunk_id for r in d}) == len(d) and all(r.embedding_text.endswith(r.content) for r in d)


def test_evidence_units(spark):
    df = spark.createDataFrame([(1, "pre\n# A\nx\n\n## B\n|a|b|c|d|\n"), (2, None), (3, "")], "k int, text string")
    got = sorted((r.key, r.section, r.line_start, r.line_end, r.kind) for r in ch.evidence_units(df, key="k", text="text").collect())
    assert got == [(1, 0, 0, 0, "section"), (1, 1, 1, 3, "section"), (1, 2, 4, 6, "table")]


def test_evidence_units_are_whole(spark):
    text = "# A\n" + "x" * 2500 + "\n|a|b|c|d|"
    df = spark.createDataFrame([(1, text)], "k int, text string")
    assert [(r.content, r.kind) for r in ch.evidence_units(df, key="k", text="text").collect()] == [(text, "table")]
    assert [(r.content, r.kind) for r in ch.evidence_units(df, key="k", text="text", most=2000).collect()] == [(text[:2000], "table")]


def test_evidence_sections_are_those_of_the_sql(spark, tmp_path):
    import duckdb

    from folioscope.plans import whole

    texts = [None, "", "# a\nb\n####\tc", "#\x0ba\n#\u3000b\n#\x0cc\n##### d\n# \n#", "a\r\n#\r\n#\x85b\n# \x0b", "\x1f# \x1c\n"]
    rows = [*enumerate(texts), *[(9, f"{'# a' if i % 2 else 'x'}\n{'b' if i % 3 else '# c'}\nd") for i in range(12)]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    columns = ("doc_id", "section", "line_start", "line_end", "chars")
    got = sorted(tuple(r[c] for c in columns) for r in whole.QUERIES["evidence_units_whole"](spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(whole.SQL["evidence_units_whole"]).fetchall())


def test_upper_median(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 1, 3, 3)] + [("b", 2)] + [("c", None)], "g string, v int")
    assert {r.g: r.upper_median for r in upper_median(df, ["g"], "v").collect()} == {"a": 3, "b": 2}
