import pytest
from pyspark.sql import functions as F

from folioscope.sources import export, files, tables
from folioscope.streaming import ingest


def test_markdown_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("a/b c.md", "markdown", "# T\n\nbody", "p1", None), ("x.csv", "csv", "", "p1", "ja")], "relative_path string, source_type string, content_markdown string, project_id string, language string")
    for _ in range(2):
        export.write_markdown(docs, str(tmp_path), fields=["project_id", "relative_path", "language"])
    text = (tmp_path / "markdown" / "a__b_c_md.md").read_text()
    assert files.front_matter(text) == ({"project_id": "p1", "relative_path": "a/b c.md"}, "# T\n\nbody")
    assert (tmp_path / "csv" / "x_csv.md").exists() and len(list(tmp_path.rglob("*.*"))) == 2


def test_statement_load_tries_again(spark, tmp_path):
    log = str(tmp_path / "sent")

    def connect():
        busy = {"n": 0}

        def send(s):
            if "busy" in s and busy["n"] < 1:
                busy["n"] += 1
                raise RuntimeError("ThrottlingException")
            if "bad" in s:
                raise ValueError("no such label")
            with open(log, "a") as f:
                f.write(s + "\n")

        return send

    s = spark.createDataFrame([("one",), ("busy",), ("bad",)], "statement string").coalesce(1)
    assert [(r.statement, r.error) for r in export.load_statements(s, connect, wait=0).collect()] == [("bad", "ValueError: no such label")]
    assert open(log).read().split() == ["one", "busy"]
    assert export.load_statements(s, connect, dry_run=True).count() == 0


def test_import_of_a_run(spark, tmp_path):
    path = str(tmp_path / "v")
    rows = spark.createDataFrame([(f"old::c{i}", "p", [1.0, float(i)]) for i in range(10)] + [("c10", "p", None)], "id string, project_id string, embedding array<float>")
    assert export.import_run(rows, path, run="exp_1", dims=2) == 1
    assert {r.id for r in tables.read_vectors(spark, path, project="exp_1").collect()} == {f"exp_1::c{i}" for i in range(10)}
    with pytest.raises(ValueError, match="rows already"):
        export.import_run(rows, path, run="exp_1", dims=2)
    export.import_run(rows, path, run="exp_1", dims=2, replace=True)
    with pytest.raises(ValueError, match="no vector"):
        export.import_run(rows, path, run="exp_2", dims=3)


def test_small_rules(spark):
    sheets = spark.createDataFrame([(1,), (2,), (3,)], "sheet_index int")
    names = spark.createDataFrame([(1, "Fields"), (2, " ")], "sheet_index int, name string")
    assert sorted((r.sheet_index, r.sheet_name) for r in export.with_sheet_names(sheets, names).collect()) == [(1, "Fields"), (2, "sheet_02"), (3, "sheet_03")]
    df = spark.createDataFrame([("x", "out/run_1/excel/book/sheet_01.md"), ("# y", "elsewhere.md")], "t string, p string")
    assert [tuple(r) for r in df.select(export.post_processed(F.col("t"), F.lit("S")), export.evidence_image(F.col("p"))).collect()] == [("# S\n\nx", "out/run_1/evidence/book/sheet_01.png"), ("# y", None)]
    inv = spark.createDataFrame([("1", "csv", 5), ("2", "csv", 5), ("3", "skip", 1)], "doc_id string, parser_type string, size_bytes long")
    done = spark.createDataFrame([("1", "parsed")], "doc_id string, state string")
    assert {r.parser_type: (r.scanned, r.parsed, r.skipped, r.open) for r in export.run_stats(inv, done).collect()} == {"csv": (2, 1, 0, 1), "skip": (1, 0, 1, 0)}


def test_streams(spark, tmp_path):
    rows = [(i, f"2024-01-0{1 + i % 3} 10:00:00", "ab"[i % 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, at string, kind string").withColumn("at", F.to_timestamp_ntz("at"))
    df.union(df).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    s = ingest.stream_table(spark, str(tmp_path), "events")
    got = {(str(r.begin)[:10], r.kind): r.events for r in ingest.run_once(ingest.windowed_counts(s, time="at", by="kind"), "w", "complete").collect()}
    assert sum(got.values()) == 60 and len(got) == 6
    assert ingest.run_once(ingest.once_each(s, key="id", time="at"), "o").count() == 30
    q = ingest.ingest_documents(s, str(tmp_path / "out"), lambda b: b.withColumn("project_id", F.col("kind")), str(tmp_path / "state"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60
