"""Command line: scan and parse a project, build its knowledge base, ask it, show its graph."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from folioscope.functions import models
from folioscope.operators import chunking as ch
from folioscope.plans import display
from folioscope.plans.retriever import Retriever, index_chunks
from folioscope.runtime import ship
from folioscope.sources import files, tables


def _session() -> SparkSession:
    return SparkSession.builder.appName("folioscope").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def scan(a, spark) -> None:
    inventory = files.scan(spark, a.path, tables.checked_id(a.project))
    for r in tables.manifest(inventory).collect():
        print(json.dumps(json.loads(r.manifest), ensure_ascii=False, indent=2))


def parse(a, spark) -> None:
    inventory = files.scan(spark, a.path, tables.checked_id(a.project))
    done = spark.read.parquet(a.out) if not a.force and tables.exists(spark, a.out) else None
    todo = files.pending(inventory, done, vision=not a.no_vision, force=a.force, limit=a.limit)
    parsed = files.parse_files(spark, todo).join(inventory.select("doc_id", "project_id", "relative_path", "source_type", "parser_type"), "doc_id")
    parsed.write.mode("overwrite" if a.force else "append").parquet(a.out)
    spark.read.parquet(a.out).groupBy("state", "parser_type").count().orderBy("state", "parser_type").show()


def build(a, spark) -> None:
    docs = spark.read.parquet(a.parsed).filter("state = 'parsed'").withColumn("strategy", ch.strategy(F.col("source_type"), F.col("parser_type")))
    cut = ch.chunk_documents(docs, key="doc_id", body="content_markdown", strategy="strategy")
    info = docs.select(F.col("doc_id").alias("key"), "project_id", "source_type", F.lit("").alias("workbook_name"), F.lit("").alias("sheet_name"))
    chunks = ch.described(cut.join(info, "key"), source_type=F.col("source_type"), document=F.col("key"), sheet_name=F.col("sheet_name"))
    tables.write_vectors(index_chunks(chunks), a.out, project=a.project, replace=a.replace, dims=1024)
    print(tables.read_vectors(spark, a.out, project=a.project, columns=["chunk_id"]).count(), "chunks")


def ask(a, spark) -> None:
    if not 1 <= a.top <= 20:
        raise SystemExit("top must lie between 1 and 20")
    rows = tables.read_vectors(spark, a.vectors, project=a.project)
    hits, trace = Retriever(spark, rows).retrieve(a.query, project=a.project, k=a.top, rerank=a.rerank)
    found = hits.orderBy(F.desc("score"), "chunk_id").collect()
    print(f"intent {trace.intent} ({trace.confidence}), stages {', '.join(trace.stages)}")
    for r in found:
        print(f"{r.score:.4f} {r.chunk_id}\n  {r.content[:200]!r}")
    if a.answer and found:
        print(spark.range(1).select(models.extractive_answer(F.lit(found[0].content)).alias("a")).first().a)


def graph(a, spark) -> None:
    nodes, edges = spark.read.parquet(a.nodes), spark.read.parquet(a.edges)
    if a.project:
        nodes = nodes.filter(F.col("project_id") == tables.checked_id(a.project))
    print(display.FORMATS[a.format](*display.limited(nodes, edges)))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="folioscope", description=__doc__)
    sub = p.add_subparsers(required=True)

    def command(f, *names, **options):
        c = sub.add_parser(f.__name__)
        c.set_defaults(run=f)
        for n in names:
            c.add_argument(n)
        for n, kw in options.items():
            c.add_argument("--" + n.replace("_", "-"), **kw)

    flag = {"action": "store_true"}
    command(scan, "path", project={"required": True})
    command(parse, "path", "out", project={"required": True}, force=flag, no_vision=flag, limit={"type": int})
    command(build, "parsed", "out", project={"required": True}, replace=flag)
    command(ask, "vectors", "query", project={"required": True}, top={"type": int, "default": 5}, rerank=flag, answer=flag)
    command(graph, "nodes", "edges", project={}, format={"choices": sorted(display.FORMATS), "default": "compact"})
    a = p.parse_args(argv)
    spark = _session()
    ship(spark)
    a.run(a, spark)


if __name__ == "__main__":
    main()
