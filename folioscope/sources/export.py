"""Results out of the engine: Markdown files, statement loads, imports of experiment runs, evidence paths."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.sources.files import safe_name
from folioscope.sources.tables import checked_id, write_vectors


def with_header(fields: dict, body: str) -> str:
    """A Markdown text with its front matter; values are written as JSON, which is YAML."""
    lines = [f"{k}: {json.dumps(v, ensure_ascii=False)}" for k, v in fields.items() if v is not None]
    return "\n".join(["---", *lines, "---", "", body])


def write_markdown(docs: DataFrame, root: str, *, fields: list[str]) -> None:
    """One file per document under ``root/<source_type>/``, written by the executors; a file that is there is replaced.

    ``docs``: relative_path, source_type, content_markdown and the columns of the front matter.
    """
    from pathlib import Path

    def write(rows: Iterable) -> None:
        for r in rows:
            path = Path(root, r.source_type, safe_name(r.relative_path) + ".md")
            path.parent.mkdir(parents=True, exist_ok=True)
            part = path.with_suffix(".part")
            part.write_text(with_header({f: r[f] for f in fields}, r.content_markdown or ""), encoding="utf-8")
            part.replace(path)  # whole or not at all, also when a task runs twice

    docs.select("relative_path", "source_type", "content_markdown", *[f for f in fields if f not in ("relative_path", "source_type")]).foreachPartition(write)


def post_processed(text: Column, title: Column) -> Column:
    """A sheet's Markdown that begins with a heading of first level."""
    body = tx.strip(F.coalesce(text, F.lit("")))
    return F.when(body.startswith("# "), body).otherwise(F.concat(F.lit("# "), title, F.lit("\n\n"), body))


def with_sheet_names(sheets: DataFrame, names: DataFrame) -> DataFrame:
    """Sheets with their display names; a sheet without one is called by its number."""
    n = names.select("sheet_index", F.col("name").alias("given_"))
    return sheets.join(n, "sheet_index", "left").withColumn("sheet_name", F.coalesce(F.when(tx.strip(F.col("given_")) != "", F.col("given_")), F.format_string("sheet_%02d", F.col("sheet_index").cast("int")))).drop("given_")


# Tries of a load, and errors of a service that is too busy.
TRIES, FIRST_WAIT = 3, 5.0
BUSY = ("ThrottlingException", "TooManyRequests", "ConcurrentModification", "Timeout")


def load_statements(statements: DataFrame, connect: Callable[[], Callable[[str], object]], *, dry_run: bool = False, wait: float = FIRST_WAIT) -> DataFrame:
    """Statements run against a graph database by the executors: (statement, error) of those that failed.

    ``connect`` makes a function that runs one statement, once per partition. Busy errors are tried again after
    growing waits. The statements are MERGEs, so that a partition may run twice. A dry run sends nothing.
    """

    def run(batches):
        import pyarrow as pa

        send = None if dry_run else connect()
        for batch in batches:
            failed, errors = [], []
            for s in batch.column(0).to_pylist():
                for n in range(TRIES):
                    try:
                        if send:
                            send(s)
                        break
                    except Exception as e:
                        said = f"{type(e).__name__}: {e}"
                        if n == TRIES - 1 or not any(b in said for b in BUSY):
                            failed.append(s)
                            errors.append(said[:300])
                            break
                        time.sleep(wait * 2**n)
            yield pa.RecordBatch.from_arrays([pa.array(failed, pa.string()), pa.array(errors, pa.string())], names=["statement", "error"])

    return statements.select("statement").mapInArrow(run, "statement string, error string")


def import_run(rows: DataFrame, path: str, *, run: str, dims: int, replace: bool = False, most_failed: float = 0.1) -> int:
    """A run of an experiment into the vector table, its ids prefixed with the run; refused if too many rows have no vector.

    Returns the number of rows left out."""
    checked_id(run)
    counts = rows.agg(F.count("*").alias("n"), F.count_if(F.col("embedding").isNull() | (F.size("embedding") != dims)).alias("bad")).first()
    if counts.bad > most_failed * counts.n:
        raise ValueError(f"{counts.bad} of {counts.n} rows have no vector")
    prefixed = rows.withColumn("source_project_id", F.col("project_id")).withColumn("project_id", F.lit(run)).withColumn("id", F.concat(F.lit(f"{run}::"), F.regexp_replace("id", "^.*::", "")))
    write_vectors(prefixed, path, project=run, replace=replace, dims=dims)
    return counts.bad


def run_stats(inventory: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row per parser: files scanned, parsed, failed, skipped."""
    both = inventory.join(parsed.select("doc_id", "state"), "doc_id", "left")
    skipped = F.col("parser_type") == "skip"
    return both.groupBy("parser_type").agg(
        F.count("*").alias("scanned"), F.count_if(F.col("state") == "parsed").alias("parsed"), F.count_if(F.col("state") == "parse_failed").alias("failed"),
        F.count_if(skipped).alias("skipped"), F.count_if(F.col("state").isNull() & ~skipped).alias("open"), F.sum("size_bytes").alias("bytes"),
    )


def evidence_image(markdown_path: Column) -> Column:
    """Where the image of a parsed sheet lies: the run's folder of evidence, by the sheet's name."""
    root = F.regexp_extract(markdown_path, r"^(.*/run_[^/]*)", 1)
    stem = F.regexp_extract(markdown_path, r"([^/]+)\.md$", 1)
    book = F.regexp_extract(markdown_path, r"([^/]+)/[^/]+$", 1)
    return F.when((root != "") & (stem != ""), F.concat_ws("/", root, F.lit("evidence"), book, F.concat(stem, F.lit(".png"))))
