"""Graph rows from chunks: entities by patterns, keyword graphs, model output and its repair."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.rules import first_match
from folioscope.functions.text import all_matches, normalize_id

# Words of a query that tell what its terms are, in order.
CONTEXT = (
    ("api", ("api", "endpoint", "エンドポイント")), ("mapping", ("マッピング", "mapping", "変換")), ("rule", ("ルール", "条件", "rule", "condition")),
    ("process", ("フロー", "処理", "flow", "process", "シーケンス")), ("status", ("ステータス", "status", "状態")), ("file", ("ファイル", "file", "パス")), ("system", ("システム", "system", "サーバ")),
)


def context(text: Column) -> Column:
    low = F.lower(text)
    return first_match([(low.rlike("|".join(words)), F.lit(label)) for label, words in CONTEXT], F.lit(None).cast("string"))


def entities(df: DataFrame, *, key: str, text: str, source: str) -> DataFrame:
    """(key, text, type, confidence, place, source): codes, upper case, camel case, katakana and kanji terms of a text."""
    c, t = F.col(text), F.col("ctx_")
    kinds = (
        (r"(?<![A-Za-z0-9_])[A-Z]\d{2,4}(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])\d{3,4}(?![A-Za-z0-9_])", lambda x: F.lit("id_code"), F.lit(0.9)),
        (r"(?U)\b[A-Z][A-Z0-9_]{2,}\b", lambda x: F.when(x.contains("_"), "field").otherwise("id_code"), F.lit(0.8)),
        (r"(?U)\b[A-Z][a-z]+(?:[A-Z][a-z]+)+\b", lambda x: F.when(t.isin("api", "system"), t).otherwise(F.lit("api")), F.lit(0.7)),
        (r"[゠-ヿ]{2,}", lambda x: F.coalesce(t, F.lit("business_term")), F.when(t.isNotNull(), 0.75).otherwise(0.7)),
        (r"[一-鿿]{2,}", lambda x: F.coalesce(t, F.lit("business_term")), F.when(t.isNotNull(), 0.7).otherwise(0.6)),
    )

    def tagged(pattern: str, kind, sure: Column) -> Column:
        return F.transform(all_matches(c, pattern), lambda x: F.struct(x.alias("text"), kind(x).cast("string").alias("type"), sure.cast("double").alias("confidence")))

    found = [tagged(*k) for k in kinds]
    rows = df.filter(c.isNotNull()).withColumn("ctx_", context(c)).select(F.col(key).alias("key"), F.posexplode(F.concat(*found)).alias("place", "e"))
    return rows.select("key", "e.text", "e.type", "e.confidence", "place", F.lit(source).alias("source"))


def keyword_graph(chunks: DataFrame, *, sheet: Column, project: str = "project_id", systems: str = "systems") -> tuple[DataFrame, DataFrame]:
    """A Sheet node per sheet, a System node per system of its chunks, and REFERENCES edges between them."""
    known = chunks.filter(F.col(project).isNotNull()).select(F.col(project).alias("project_id"), sheet.alias("sheet"), F.explode_outer(systems).alias("system")).distinct()
    sheet_id = F.concat_ws(":", F.lit("sheet"), "project_id", normalize_id(F.col("sheet"), "unicode"))
    system_id = F.concat_ws(":", F.lit("system"), "project_id", normalize_id(F.col("system"), "unicode"))
    named = known.filter("system is not null and system <> ''")
    nodes = known.select(sheet_id.alias("node_id"), F.lit("Sheet").alias("label"), F.col("sheet").alias("name"), "project_id").distinct()
    nodes = nodes.unionByName(named.groupBy(system_id.alias("node_id"), "project_id").agg(F.min("system").alias("name")).withColumn("label", F.lit("System")))
    edges = named.select(sheet_id.alias("from_id"), system_id.alias("to_id"), F.lit("REFERENCES").alias("relationship"), "project_id").distinct()
    return nodes, edges


def repaired_json(text: str):
    """The value of a model's JSON answer: fences are taken off, what was cut off is closed after the last whole object; None if there is nothing to save."""
    body = re.sub(r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", "", text or "").strip()
    begin = min((i for i in (body.find("["), body.find("{")) if i >= 0), default=-1)
    if begin < 0:
        return None
    body = body[begin:]
    try:
        return json.JSONDecoder().raw_decode(body)[0]
    except ValueError:
        pass
    stack, quoted, escaped, saved = [], False, False, None
    for i, ch in enumerate(body):
        if quoted:
            quoted, escaped = not (ch == '"' and not escaped), ch == "\\" and not escaped
        elif ch == '"':
            quoted = True
        elif ch in "[{":
            stack.append("]" if ch == "[" else "}")
        elif ch in "]}" and stack:
            stack.pop()
            if ch == "}" and stack:
                saved = (i + 1, "".join(reversed(stack)))
    if saved is None:
        return None
    try:
        return json.loads(body[: saved[0]] + saved[1])
    except ValueError:
        return None


NODES = "doc_key string, id string, entity_type string, name string, confidence double"
EDGES = "doc_key string, start_id string, end_id string, type string, confidence double"


def _rows(value, name: str) -> list[dict]:
    found = value.get(name, []) if isinstance(value, dict) else value if isinstance(value, list) else []
    return [x for x in found if isinstance(x, dict)]


def _number(x) -> float:
    try:
        return min(1.0, max(0.0, float(x)))
    except (TypeError, ValueError):
        return 0.5


def extract_graph(docs: DataFrame, model: Callable[[str], str], *, key: str, text: str, least: int = 100, most_nodes: int = 80) -> tuple[DataFrame, DataFrame]:
    """Two passes of a model over each document: nodes, then edges given the ids of the first ``most_nodes`` nodes.

    The model's answers are repaired; both spellings of endpoints are read; confidences are brought to 0..1. The
    answers are written once as a table, so that the model is asked once however often the result is read.
    """
    from folioscope.runtime import materialize

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [], []
            for doc in batch.column("doc").to_pylist():
                answer = model(f"NODES\n{doc}")
                ids = [str(n.get("id")) for n in _rows(repaired_json(answer), "nodes")][:most_nodes]
                first.append(answer)
                second.append(model(f"EDGES\n{json.dumps(ids, ensure_ascii=False)}\n{doc}"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_key"), pa.array(first, pa.string()), pa.array(second, pa.string())], names=["doc_key", "nodes", "edges"])

    given = docs.filter(F.length(text) >= least).select(F.col(key).cast("string").alias("doc_key"), F.col(text).alias("doc"))
    answers = materialize(given.mapInArrow(ask, "doc_key string, nodes string, edges string"), "answers")

    def read(name: str, pick):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [(k, *pick(x)) for k, answer in zip(batch.column("doc_key").to_pylist(), batch.column(name).to_pylist()) for x in _rows(repaired_json(answer), name)]
                cols = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays([*[pa.array([None if v is None else str(v) for v in c], pa.string()) for c in cols[:4]], pa.array(list(cols[4]), pa.float64())], names=["doc_key", "a", "b", "c", "d"])

        return run

    nodes = answers.mapInArrow(read("nodes", lambda x: (x.get("id"), x.get("entity_type") or x.get("type"), x.get("name"), _number(x.get("confidence", 0.5)))), "doc_key string, a string, b string, c string, d double")
    edges = answers.mapInArrow(read("edges", lambda x: (x.get("from_id") or x.get("from"), x.get("to_id") or x.get("to"), x.get("type"), _number(x.get("confidence", 0.5)))), "doc_key string, a string, b string, c string, d double")
    return nodes.toDF(*[p.split()[0] for p in NODES.split(", ")]), edges.toDF(*[p.split()[0] for p in EDGES.split(", ")])
