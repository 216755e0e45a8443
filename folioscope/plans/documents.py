"""Queries of documents: splitting, evidence, statistics, windows, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions import rules
from folioscope.operators import chunking as ch
from folioscope.operators import stats
from folioscope.operators.graph import top_n_per
from folioscope.runtime import table


def chunk_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("text is not null").withColumn("strategy", F.lit("semantic"))
    c = ch.chunk_documents(d, key="doc_id", body="text", strategy="strategy")
    return ch.described(c, source_type=F.lit("doc"), document=F.col("key"), sheet_name=F.lit("")).select(F.col("key").cast("bigint").alias("doc_id"), "chunk_index", "chunk_id", "chunk_type", "section_name", F.length("content").alias("chars"))


def chunk_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("text is not null").withColumn("strategy", F.lit("fixed"))
    c = ch.chunk_documents(d, key="doc_id", body="text", strategy="strategy")
    return c.select(F.col("key").cast("bigint").alias("doc_id"), "chunk_index", F.sha2("content", 256).alias("digest"), F.length("content").alias("chars"))


def chunk_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents joined per document in chunk order, split again by the strategy of their source."""
    c = table(spark, sf_dir, "chunks").filter("content is not null").groupBy("document_id", "chunk_index").agg(F.min(F.struct("pos", "content", "source_type")).alias("r"))
    d = c.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "r.content"))), lambda x: x["content"]), "\n\n").alias("body"), F.min("r.source_type").alias("source_type"))
    d = d.withColumn("strategy", ch.strategy(F.col("source_type")))
    out = ch.chunk_documents(d, key="document_id", body="body", strategy="strategy")
    return out.select(F.col("key").alias("document_id"), "chunk_index", "label", F.length("content").alias("chars"))


def evidence_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = ch.evidence_units(table(spark, sf_dir, "documents"), key="doc_id", text="text")
    return u.select(F.col("key").alias("doc_id"), "section", "line_start", "line_end", F.length("content").alias("chars"))


def related_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of rules and tables that stand in one paragraph."""
    return ch.mentions_together(table(spark, sf_dir, "documents"), key="doc_id", text="text", pattern="[A-Z]{2}[0-9]{4}")


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("text is not null")
    return d.select("doc_id", F.posexplode(F.split("text", "\n\n")).alias("no", "paragraph")).groupBy("doc_id").agg(F.count("*").alias("paragraphs"), F.max(F.length("paragraph")).alias("longest"))


def stats_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of chunks by type, with the upper median."""
    c = table(spark, sf_dir, "chunks").filter("content is not null").withColumn("chars", F.length("content"))
    return stats.length_stats(c, ["chunk_type"], "chars", tables=F.col("content").contains("|---"), diagrams=F.col("content").contains("```mermaid"))


def stats_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks")
    return c.groupBy("project_id", "source_type").agg(F.count_distinct("source_file").alias("files"), F.count("*").alias("chunks"), F.sum(F.length("content")).alias("chars"))


def stats_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs compared: rows, ids, valid vectors, text lengths."""
    e = table(spark, sf_dir, "dualrag_experiment_eval_chunks")
    return e.groupBy("experiment_project_id", "chunking_strategy", "graph_prompt_version").agg(
        F.count("*").alias("rows"), F.count_distinct("id").alias("ids"), F.count_if(F.size("embedding") == 1024).alias("full_vectors"),
        F.round(F.avg(F.length("text")), 1).alias("chars"), F.max("created_at").alias("last"),
    )


def stats_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of experiments whose run or source project does not fit: an id of another run, a project that is not there."""
    e = table(spark, sf_dir, "dualrag_experiment_eval_chunks")
    p = table(spark, sf_dir, "projects").select(F.col("project_id").alias("p"))
    foreign = ~F.col("id").startswith(F.concat(F.col("experiment_project_id"), F.lit("::")))
    return e.join(p, F.col("source_project_id") == F.col("p"), "left").groupBy("experiment_project_id").agg(F.count_if(foreign).alias("foreign_ids"), F.count_if(F.col("p").isNull()).alias("no_project"))


def stats_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left outer: every project with its chunks, nodes and edges; missing counts are 0."""
    p = table(spark, sf_dir, "projects").select("project_id", "display_name")
    for name in ("chunks", "graph_nodes", "graph_edges"):
        p = p.join(table(spark, sf_dir, name).groupBy("project_id").agg(F.count("*").alias(name)), "project_id", "left")
    return p.fillna(0, ["chunks", "graph_nodes", "graph_edges"])


def stats_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How late chunks arrive, by month of parsing (ingested more than a week after)."""
    c = table(spark, sf_dir, "chunks").filter("parsed_at is not null and ingested_at is not null")
    late = F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col("parsed_at").cast("timestamp")) > 7 * 86_400_000_000
    return c.groupBy(F.date_trunc("month", "parsed_at").cast("timestamp_ntz").alias("month")).agg(F.count("*").alias("chunks"), F.count_if(late).alias("late"))


def session_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 20 events of each user."""
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    last = top_n_per(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 20, "event_id")
    return last.withColumn("n", F.row_number().over(w)).select("user_id", "event_id", "n")


def session_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user: events not more than 30 minutes apart."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("events"), F.min("ts").alias("begin"))
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("events").alias("most"))


def session_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "1 day")["start"].cast("timestamp_ntz").alias("day"), "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("value"))


def set_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of nodes and of reference entries: in both, only typed, only listed."""
    n = table(spark, sf_dir, "graph_nodes").filter("name is not null").select("name")
    r = table(spark, sf_dir, "ref_entities").select("name")
    part = lambda df, label: df.select("name", F.lit(label).alias("part"))
    return part(n.intersect(r), "both").unionByName(part(n.exceptAll(r).distinct().subtract(r), "typed")).unionByName(part(r.subtract(n), "listed"))


def metadata_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of which a field of their provenance is missing, by source type."""
    c = table(spark, sf_dir, "chunks")
    blank = lambda f: F.count_if(F.coalesce(F.trim(f), F.lit("")) == "").alias(f)
    return c.groupBy("source_type").agg(*[blank(f) for f in ("project_id", "section_name", "content_hash", "chunk_mode", "content")])


def content_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets and diagrams of one project linked by the names they share: the best sheet of every diagram."""
    n = table(spark, sf_dir, "graph_nodes").filter("project_id is not null and workbook_name is not null and name is not null and length(name) > 3")
    by = n.select("project_id", "workbook_name", F.col("properties")["origin"].alias("origin"), F.lower("name").alias("word")).distinct()
    return stats.best_overlap(by.filter("origin = 'mermaid'").select("project_id", F.col("workbook_name").alias("diagram"), "word"), by.filter("origin = 'llm'").select("project_id", F.col("workbook_name").alias("book"), "word"))


_LEN = "length(content)"
QUERIES = {
    f.__name__: f
    for f in (
        chunk_semantic, chunk_fixed, chunk_by_source, evidence_units, related_codes, paragraphs, stats_chunks, stats_manifest, stats_experiments, stats_isolation, stats_projects,
        stats_late, session_last, session_gaps, session_hours, set_names, metadata_gaps, content_overlap,
    )
}
SQL = {
    "evidence_units": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS c, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE text IS NOT NULL),
        s AS (SELECT *, sum(regexp_matches(c, '^#{1,4}\s+')::int) OVER (PARTITION BY doc_id ORDER BY line) AS section FROM l),
        u AS (SELECT doc_id, section, min(line) AS line_start, max(line) AS line_end, string_agg(c, chr(10) ORDER BY line) AS c FROM s GROUP BY 1, 2),
        v AS (SELECT *, length(substr(regexp_replace(c, '^[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', '', 'g'), 1, 2000)) AS chars FROM u)
        SELECT doc_id, section, line_start, line_end, chars FROM v WHERE chars > 0""",
    "paragraphs": """WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS p FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, count(*) AS paragraphs, max(length(p)) AS longest FROM p GROUP BY 1""",
    "related_codes": r"""WITH p AS (SELECT DISTINCT list_distinct(regexp_extract_all(p, '[A-Z]{2}[0-9]{4}')) AS m FROM (SELECT unnest(regexp_split_to_array(text, '\n\s*\n')) AS p FROM documents)),
        x AS (SELECT unnest(m) AS a, m FROM p WHERE len(m) > 1), y AS (SELECT a, unnest(m) AS b FROM x) SELECT DISTINCT a, b FROM y WHERE a <> b""",
    "stats_chunks": f"""SELECT chunk_type, count(*) AS n, round(avg({_LEN}), 1) AS mean, min({_LEN}) AS least, max({_LEN}) AS most,
        list_sort(list({_LEN}))[(count(*) // 2)::int + 1] AS upper_median, count_if(contains(content, '|---')) AS tables, count_if(contains(content, '```mermaid')) AS diagrams
        FROM chunks WHERE content IS NOT NULL GROUP BY 1""",
    "stats_manifest": "SELECT project_id, source_type, count(DISTINCT source_file) AS files, count(*) AS chunks, sum(length(content)) AS chars FROM chunks GROUP BY 1, 2",
    "stats_experiments": """SELECT experiment_project_id, chunking_strategy, graph_prompt_version, count(*) AS rows, count(DISTINCT id) AS ids, count_if(len(embedding) = 1024) AS full_vectors,
        round(avg(length(text)), 1) AS chars, max(created_at) AS last FROM dualrag_experiment_eval_chunks GROUP BY 1, 2, 3""",
    "stats_isolation": """SELECT experiment_project_id, count_if(NOT starts_with(id, experiment_project_id || '::')) AS foreign_ids, count_if(p.project_id IS NULL) AS no_project
        FROM dualrag_experiment_eval_chunks e LEFT JOIN (SELECT project_id FROM projects) p ON e.source_project_id = p.project_id GROUP BY 1""",
    "stats_projects": """SELECT p.project_id, p.display_name, coalesce(c.n, 0) AS chunks, coalesce(g.n, 0) AS graph_nodes, coalesce(e.n, 0) AS graph_edges FROM projects p
        LEFT JOIN (SELECT project_id, count(*) AS n FROM chunks GROUP BY 1) c USING (project_id) LEFT JOIN (SELECT project_id, count(*) AS n FROM graph_nodes GROUP BY 1) g USING (project_id)
        LEFT JOIN (SELECT project_id, count(*) AS n FROM graph_edges GROUP BY 1) e USING (project_id)""",
    "stats_late": """SELECT date_trunc('month', parsed_at)::timestamp AS month, count(*) AS chunks, count_if(epoch_us(ingested_at) - epoch_us(parsed_at) > 604800000000) AS late
        FROM chunks WHERE parsed_at IS NOT NULL AND ingested_at IS NOT NULL GROUP BY 1""",
    "session_last": "SELECT user_id, event_id, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 20",
    "session_gaps": """WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < 1800000000 THEN 0 ELSE 1 END AS new FROM events),
        s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g),
        c AS (SELECT user_id, session, count(*) AS events FROM s GROUP BY 1, 2) SELECT user_id, count(*) AS sessions, max(events) AS most FROM c GROUP BY 1""",
    "session_hours": "SELECT date_trunc('day', ts)::timestamp AS day, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY 1, 2",
    "set_names": """SELECT DISTINCT name, 'both' AS part FROM graph_nodes WHERE name IN (SELECT name FROM ref_entities)
        UNION ALL SELECT DISTINCT name, 'typed' FROM graph_nodes WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM ref_entities)
        UNION ALL SELECT DISTINCT name, 'listed' FROM ref_entities WHERE name NOT IN (SELECT name FROM graph_nodes WHERE name IS NOT NULL)""",
    "metadata_gaps": "SELECT source_type, "
    + ", ".join(f"count_if(coalesce(trim({f}), '') = '') AS {f}" for f in ("project_id", "section_name", "content_hash", "chunk_mode", "content"))
    + " FROM chunks GROUP BY 1",
    "content_overlap": """WITH b AS (SELECT DISTINCT project_id, workbook_name, properties['origin'] AS origin, lower(name) AS word FROM graph_nodes
          WHERE project_id IS NOT NULL AND workbook_name IS NOT NULL AND name IS NOT NULL AND length(name) > 3),
        p AS (SELECT d.project_id, d.workbook_name AS diagram, l.workbook_name AS book, count(*) AS shared FROM b d JOIN b l USING (project_id, word) WHERE d.origin = 'mermaid' AND l.origin = 'llm' GROUP BY 1, 2, 3)
        SELECT project_id, diagram, book, shared FROM (SELECT *, row_number() OVER (PARTITION BY project_id, diagram ORDER BY shared DESC, book) AS r FROM p) WHERE r = 1""",
}
