import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from folioscope.sources import files, tables


def docx(paragraphs):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    p = "".join(f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>' for s, t in paragraphs)
    t = "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{c}</w:t></w:r></w:p></w:tc>" for c in r) + "</w:tr>" for r in (("h1", "h2"), ("1",))) + "</w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{p}{t}</w:body></w:document>')
    return out.getvalue()


@pytest.fixture
def tree(tmp_path):
    put = lambda name, data: ((tmp_path / name).parent.mkdir(parents=True, exist_ok=True), (tmp_path / name).write_bytes(data if isinstance(data, bytes) else data.encode()))
    put("spec/a.md", "# Spec\n\nbody")
    put("spec/fields.csv", "項目名,桁数,必須\nname,\"10,2\",yes\n".encode("cp932"))
    put("spec/page.html", "<html><head><title>Page</title><script>x()</script></head><body><nav>skip</nav><h1>One</h1><p>a <b>b</b></p><ul><li>x</li></ul><table><tr><th>h</th></tr><tr><td>c</td></tr></table></body></html>")
    put("code/Order.java", "class Order {}")
    put("code/lib.min.js", "x")
    put("notes.txt", "line\nline")
    put("old/book.doc", b"\xd0\xcf\x11\xe0old")
    put("doc/text.docx", docx([("Heading1", "Top"), ("Normal", "para"), ("ListParagraph", "item")]))
    put("flow/f.mmd", "flowchart TD\nA --> B")
    put("empty.md", "")
    put(".hidden.md", "x")
    put("Thumbs.db", "x")
    put("pic/icon.png", b"x" * 10)
    return str(tmp_path)


def test_scan_and_parse(spark, tree):
    inv = files.scan(spark, tree, "p1")
    kinds = {r.relative_path: (r.source_type, r.parser_type) for r in inv.collect()}
    assert kinds == {
        "spec/a.md": ("markdown", "markdown"), "spec/fields.csv": ("csv", "csv"), "spec/page.html": ("html", "html"), "code/Order.java": ("code", "code"), "code/lib.min.js": ("unknown", "skip"),
        "notes.txt": ("plaintext", "text"), "old/book.doc": ("docx", "doc_vlm"), "doc/text.docx": ("docx", "docx"), "flow/f.mmd": ("mermaid", "mermaid"), "pic/icon.png": ("image", "skip"),
    }
    todo = files.pending(inv)
    got = {r.relative_path: r for r in files.parse_files(spark, todo).join(inv.select("doc_id", "relative_path"), "doc_id").collect()}
    assert len(got) == 7 and got["old/book.doc"].state == "parse_failed" and got["old/book.doc"].error
    assert got["spec/fields.csv"].content_markdown == "# fields\n\n### name\n- 桁数: 10,2\n- 必須: yes"
    page = got["spec/page.html"]
    assert page.title == "Page" and "# One" in page.content_markdown and "- x" in page.content_markdown and "| c |" in page.content_markdown and "skip" not in page.content_markdown
    assert got["doc/text.docx"].content_markdown == "# Top\n\npara\n\n- item\n\n| h1 | h2 |\n|---|---|\n| 1 |  |"
    assert got["code/Order.java"].content_markdown.startswith("# Order.java\n\n```java\n") and got["spec/a.md"].title == "Spec"
    done = files.parse_files(spark, todo).filter("state = 'parsed'")
    assert [r.relative_path for r in files.pending(inv, done).collect()] == ["old/book.doc"]
    assert files.discover(inv, types=["csv"]).count() == 1 and files.discover(inv, pattern="*.j*").count() == 2 and files.discover(inv, folder="spec").count() == 3
    plugged = files.parse_files(spark, todo, more={"doc_vlm": lambda raw, path: ("t", "seen")}).filter("content_markdown = 'seen'")
    assert plugged.count() == 1
    m = json.loads(tables.manifest(inv).first().manifest)
    assert m["files"] == 10 and m["source_type"]["csv"] == 1


@pytest.mark.parametrize(("text", "title", "markdown"), [
    ("Spec,,\n,,\n項目名,桁数,必須\n【注文】,,\nid,10,yes\n,,see note\nqty,3,no\n", "Spec", "# Spec\n\n## 注文\n\n### id\n- 桁数: 10\n- 必須: yes see note\n\n### qty\n- 桁数: 3\n- 必須: no"),
    ("ページ,変更内容\n1,added\n2,fixed\n", "f", "# f\n\n- ページ: 1, 変更内容: added\n\n- ページ: 2, 変更内容: fixed"),
    ("項目名,種別,備考\na,x,one\n,,two\n", "f", "# f\n\n| 項目名 | 種別 | 備考 |\n|---|---|---|\n| a | x | one two |"),
    ("a note,\n【Part】,\nmore text,here\n", "f", "# f\n\na note\n\n## Part\n\nmore text here"),
    ("k,v\n1,2\n", "f", "# f\n\n| k | v |\n|---|---|\n| 1 | 2 |"), ("", "f", "# f"),
])
def test_csv_layouts(text, title, markdown):
    assert files.parse_csv(text.encode(), "d/f.csv") == (title, markdown)
    assert files.parse_csv(text.replace(",", "\t").encode("utf-16"), "d/f.tsv")[0] == title


def test_front_matter(spark):
    good = "---\nproject_id: p1\npages: [1, 2]\n---\n\nbody"
    assert files.front_matter(good) == ({"project_id": "p1", "pages": [1, 2]}, "body")
    for bad in ("no", "---\na: 'open\n---\nx", "---\n- 1\n---\nx", "---\nnever closed"):
        assert files.front_matter(bad) == ({}, bad)
    df = files.with_front_matter(spark.createDataFrame([(good,), ("plain",), (None,)], "text string"))
    rows = df.select("fields", "body").collect()
    assert rows[0].fields == {"project_id": "p1", "pages": "[1, 2]"} and rows[1].body == "plain"
    assert files.checked_project(df, "p1").select("project_id").distinct().first()[0] == "p1"
    with pytest.raises(Exception, match="front matter"):
        files.checked_project(df, "p2").select("project_id", "body").collect()


def test_safe_names():
    assert files.safe_name("a/b/c d.MD") == "b__c_d_md" and len(files.safe_name("x" * 300 + ".txt")) <= 124


def test_vector_table(spark, tmp_path):
    path = str(tmp_path / "vectors")
    rows = spark.createDataFrame([("a", "p1", [1.0, 0.0]), ("b", "p1", None), ("c", "p2", [0.0, 1.0])], "chunk_id string, project_id string, embedding array<float>")
    tables.write_vectors(rows, path, project="p1", dims=2)
    tables.write_vectors(rows, path, project="p2", dims=2)
    assert tables.failed(rows, 2) == 1
    with pytest.raises(ValueError, match="replace"):
        tables.write_vectors(rows, path, project="p1", dims=2)
    with pytest.raises(ValueError, match="project"):
        tables.write_vectors(rows, path, project=None, replace=True)
    with pytest.raises(ValueError, match="not a project id"):
        tables.checked_id("p1'; drop")
    again = rows.filter("chunk_id = 'a'").withColumn("chunk_id", F.lit("z")).withColumn("extra", F.lit(1))
    for _ in range(2):  # twice is once
        tables.write_vectors(again, path, project="p1", replace=True, dims=2)
    got = tables.read_vectors(spark, path).select("chunk_id", "project_id", "extra").collect()
    assert sorted((r.chunk_id, r.project_id, r.extra) for r in got) == [("c", "p2", None), ("z", "p1", 1)]
    plan = tables.read_vectors(spark, path, project="p1", columns=["chunk_id"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(project_id" in plan and "embedding" not in plan


def test_json_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", None)], "id string, names array<string>")
    tables.write_json_lines(df, str(tmp_path / "j"))
    assert sorted(tables.read_json_lines(spark, str(tmp_path / "j"), "id string, names array<string>").collect()) == sorted(df.collect())
