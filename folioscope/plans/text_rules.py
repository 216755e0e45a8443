"""Queries of identifiers, text expressions and rule classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import ids, rules
from folioscope.functions import text as tx
from folioscope.runtime import table


def ids_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("project_id is not null and source is not null")
    path = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    return d.select("doc_id", ids.document_id(F.col("project_id"), path).alias("by_path"), ids.document_id(F.col("project_id"), path, ":").alias("by_book"))


def ids_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks").filter("content is not null")
    label, digest = ids.unit_label(F.col("sheet_name")), ids.content_hash(F.col("content"))
    return c.select("pos", label.alias("unit"), digest.alias("digest"), ids.chunk_id(F.col("source_type"), F.col("document_id"), label, F.col("chunk_index"), digest).alias("chunk_key"))


def ids_stale_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored content hashes that are missing or no longer those of the content."""
    c = table(spark, sf_dir, "chunks").filter("content is not null")
    digest = ids.content_hash(F.col("content"))
    state = F.when(F.col("content_hash").isNull(), "missing").when(F.lower("content_hash") == digest, "valid").otherwise("stale")
    return c.groupBy(state.alias("state")).agg(F.count("*").alias("chunks"))


def ids_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "graph_nodes").filter("label is not null")
    key = ids.canonical_id(F.col("label"), F.col("name"), F.coalesce("project_id", F.lit("global")), F.col("workbook_name"), F.col("sheet_name"))
    return n.select("pos", key.alias("canonical_id"))


def text_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("text is not null")
    t = F.col("text")
    return d.select("doc_id", F.round(tx.share_of(t, tx.KANA), 4).alias("kana"), F.round(tx.share_of(t, tx.HAN), 4).alias("han"), tx.language_by_share(t).alias("by_share"), tx.language_by_count(t).alias("by_count"))


def text_chunk_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks").filter("content is not null")
    return c.select("pos", rules.chunk_type(F.col("content"), F.col("sheet_name")).alias("inferred"))


def text_names_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks").filter("content is not null")
    t = F.col("content")
    return c.select("pos", tx.found_systems(t).alias("systems"), tx.found_apis(t).alias("apis"), tx.field_codes(t).alias("codes"))


def text_table_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chunks").filter("content is not null").select("pos", tx.found_fields(F.col("content")).alias("fields"))


def text_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks").filter("content is not null")
    return c.select("pos", tx.leading_section(F.col("content")).alias("leading"), tx.first_section(F.col("content")).alias("first"))


def text_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks").filter("content is not null")
    t = F.col("content")
    return c.select("pos", rules.evidence_kind(t).alias("kind"), rules.sheet_kind(t).alias("sheet_kind"), *[v.alias(k) for k, v in rules.inventory_flags(t).items()])


def text_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "eval_items")
    t = F.col("text")
    return q.select("item_id", F.array_sort(tx.search_keywords(t)).alias("search"), tx.lexical_keywords(t).alias("lexical"))


def text_graph_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "eval_items")
    return q.select("item_id", tx.graph_keywords(F.col("text")).alias("graph_terms"), tx.guidance_terms(F.col("text")).alias("guidance"))


def text_intents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intent of every item and every node's name, read as a query, with its rewritings."""
    q = table(spark, sf_dir, "graph_nodes").filter("name is not null").select("pos", "name", rules.query_intent(F.col("name")).alias("i"))
    return q.select("pos", F.col("i.label").alias("intent"), F.col("i.confidence").alias("confidence"), rules.expanded(F.col("name"), F.col("i.label"), rules.TECHNICAL_WORDS).alias("technical"))


def text_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "graph_nodes")
    return n.groupBy((tx.safe_str(F.col("name")) == "").alias("missing")).agg(F.count("*").alias("nodes"))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, role and parser of every source file."""
    f = table(spark, sf_dir, "chunks").filter("source_file is not null").groupBy("source_file").agg(F.sum(F.length("content")).alias("size"))
    f = f.withColumn("kind", rules.file_type(F.col("source_file"))).withColumn("folder", F.element_at(F.split("source_file", "/"), 1))
    f = f.withColumn("role", rules.document_role(F.col("source_file"), F.col("folder"), F.col("kind"), F.coalesce("size", F.lit(0))))
    return f.select("source_file", "kind", "role", rules.parser_choice(F.col("source_file"), F.col("kind"), F.col("role"))["parser"].alias("parser"))


def _cases(column: str, table_: tuple, otherwise: str) -> str:
    whens = " ".join("WHEN " + " OR ".join(f"contains({column}, '{w.lower()}')" for w in words) + f" THEN '{label}'" for label, words in table_)
    return f"CASE {whens} ELSE '{otherwise}' END"


def _quoted(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_NORM = "coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({0}, ''))), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), ''), 'unknown')"
_PREFIX = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ids.TYPE_PREFIX.items()) + " ELSE substr(lower(label), 1, 20) END"
_LABEL = r"CASE WHEN coalesce(sheet_name, '') = '' THEN 'doc' WHEN regexp_extract(sheet_name, '^sheet_(\d+)', 1) <> '' THEN 's' || regexp_extract(sheet_name, '^sheet_(\d+)', 1) ELSE substr(sheet_name, 1, 20) END"
_HASH = "substr(sha256(content), 1, 12)"
_KANA = "length(regexp_replace(text, '[^぀-ヿ]', '', 'g'))"
_HAN = "length(regexp_replace(text, '[^一-鿿]', '', 'g'))"
_HITS = ", ".join("(" + " + ".join(f"contains(lower(name), '{w.lower()}')::int" for w in words) + f") AS {label}" for label, words in rules.INTENTS.items())
_TOP = "greatest(" + ", ".join(rules.INTENTS) + ")"
_INTENT = "CASE WHEN " + _TOP + " = 0 THEN 'overview' " + " ".join(f"WHEN {k} = {_TOP} THEN '{k}'" for k in rules.INTENTS) + " END"
_SURE = "CASE WHEN " + _TOP + " = 0 THEN 0.1 " + " ".join(f"WHEN {k} = {_TOP} THEN round(least(1.0, {k} / {len(w)}.0 + 0.3), 2)" for k, w in rules.INTENTS.items()) + " END"
_KIND = "CASE " + " ".join(f"WHEN regexp_extract(lower(source_file), '(\\.[^./]+)$', 1) IN {_quoted(e)} THEN '{k}'" for k, e in rules.FILE_TYPES.items()) + " ELSE 'unknown' END"

_NAME = "regexp_extract(source_file, '([^/]*)$', 1)"
_ROLE = (
    "CASE WHEN kind = 'image' AND size < 10240 THEN 'asset' WHEN kind = 'image' AND contains(lower(folder), 'assets') THEN 'screenshot' "
    "WHEN contains(lower(name), '.min.js') OR contains(lower(name), '.min.css') THEN 'asset' "
    + " ".join(f"WHEN regexp_matches(name, '(?i){p}') THEN '{r}'" for p, r in rules.NAME_ROLES)
    + " "
    + " ".join(f"WHEN regexp_matches(folder, '(?i){p}') THEN '{r}'" for p, r in rules.FOLDER_ROLES)
    + " "
    + " ".join(f"WHEN kind = '{k}' THEN '{r}'" for k, r in rules.TYPE_ROLES.items())
    + " ELSE 'unknown' END"
)
_PARSER = """CASE kind WHEN 'excel_sheet' THEN 'excel_vlm' WHEN 'pdf_native' THEN 'pdf_vlm' WHEN 'docx' THEN CASE WHEN lower(source_file) LIKE '%.doc' THEN 'doc_vlm' ELSE 'docx' END
    WHEN 'csv' THEN 'csv' WHEN 'mermaid' THEN 'mermaid' WHEN 'markdown' THEN 'markdown' WHEN 'html' THEN 'html' WHEN 'image' THEN CASE WHEN role = 'asset' THEN 'skip' ELSE 'image_vlm' END
    WHEN 'code' THEN CASE WHEN contains(lower(source_file), '.min.') THEN 'skip' ELSE 'code' END WHEN 'plaintext' THEN 'text' ELSE 'skip' END"""

QUERIES = {
    f.__name__: f
    for f in (
        ids_documents, ids_chunks, ids_stale_hashes, ids_canonical, text_languages, text_chunk_types, text_names_found, text_table_fields, text_sections,
        text_evidence, text_keywords, text_graph_terms, text_intents, text_missing_values, file_inventory,
    )
}
SQL = {
    "ids_documents": """SELECT doc_id, substr(sha256(project_id || '::' || source || '/' || doc_id), 1, 16) AS by_path,
        substr(sha256(project_id || ':' || source || '/' || doc_id), 1, 16) AS by_book FROM documents WHERE project_id IS NOT NULL AND source IS NOT NULL""",
    "ids_chunks": f"""SELECT pos, {_LABEL} AS unit, {_HASH} AS digest,
        source_type || '_' || document_id || '_' || {_LABEL} || '_c' || lpad(chunk_index::varchar, greatest(3, length(chunk_index::varchar))::int, '0') || '_' || {_HASH} AS chunk_key
        FROM chunks WHERE content IS NOT NULL""",
    "ids_stale_hashes": f"""SELECT CASE WHEN content_hash IS NULL THEN 'missing' WHEN lower(content_hash) = {_HASH} THEN 'valid' ELSE 'stale' END AS state,
        count(*) AS chunks FROM chunks WHERE content IS NOT NULL GROUP BY 1""",
    "ids_canonical": f"""WITH n AS (SELECT pos, label, coalesce(project_id, 'global') AS p, {_PREFIX} AS prefix, substr({_NORM.format("name")}, 1, 50) AS k,
          {_NORM.format("workbook_name")} AS b, {_NORM.format("sheet_name")} AS s FROM graph_nodes WHERE label IS NOT NULL)
        SELECT pos, CASE WHEN label IN {_quoted(ids.STEP_TYPES + ids.SHEET_TYPES)} THEN prefix || ':' || p || ':' || b || ':' || s || ':' || k
          WHEN label IN {_quoted(ids.GLOBAL_TYPES)} THEN prefix || ':' || p || ':' || k ELSE prefix || ':' || p || ':' || b || ':' || k END AS canonical_id FROM n""",
    "text_languages": f"""SELECT doc_id, CASE WHEN length(text) > 0 THEN round({_KANA} / length(text), 4) ELSE 0.0 END AS kana,
        CASE WHEN length(text) > 0 THEN round({_HAN} / length(text), 4) ELSE 0.0 END AS han,
        CASE WHEN {_KANA} / greatest(length(text), 1) > 0.02 THEN 'ja' WHEN {_HAN} / greatest(length(text), 1) > 0.05 THEN 'zh' ELSE 'en' END AS by_share,
        CASE WHEN {_KANA} > 5 THEN 'ja' WHEN {_HAN} > 10 THEN 'zh' ELSE 'en' END AS by_count FROM documents WHERE text IS NOT NULL""",
    "text_chunk_types": f"""WITH c AS (SELECT pos, lower(content || ' ' || coalesce(sheet_name, '')) AS t FROM chunks WHERE content IS NOT NULL)
        SELECT pos, {_cases("t", rules.CHUNK_TYPES, "overview")} AS inferred FROM c""",
    "text_names_found": f"""SELECT pos, list_filter([{", ".join(f"CASE WHEN contains(lower(content), '{n.lower()}') THEN '{n}' END" for n in tx.SYSTEM_NAMES)}], lambda x: x IS NOT NULL) AS systems,
        list_filter(regexp_extract_all(content, '(?:{tx.API_NAMES})'), lambda x, i: list_position(regexp_extract_all(content, '(?:{tx.API_NAMES})'), x) = i) AS apis,
        list_filter(regexp_extract_all(content, '(?m)^### .+?\\(`([A-Z]{{2}}\\d{{7}})`\\)', 1), lambda x, i: list_position(regexp_extract_all(content, '(?m)^### .+?\\(`([A-Z]{{2}}\\d{{7}})`\\)', 1), x) = i) AS codes
        FROM chunks WHERE content IS NOT NULL""",
    "text_evidence": f"""WITH c AS (SELECT pos, content, lower(substr(content, 1, 3000) || ' ' || substr(content, 1, 5000)) AS h FROM chunks WHERE content IS NOT NULL)
        SELECT pos, CASE WHEN contains(content, '```mermaid') THEN 'mermaid' WHEN length(content) - length(replace(content, '|', '')) > 4 THEN 'table' ELSE 'section' END AS kind,
          {_cases("h", rules.SHEET_KINDS, "unknown")} AS sheet_kind,
          {", ".join("(" + " OR ".join(f"contains(content, '{w}')" for w in words) + f") AS {k}" for k, words in rules.FLAG_WORDS.items())} FROM c""",
    "text_intents": f"""WITH n AS (SELECT pos, name, {_HITS} FROM graph_nodes WHERE name IS NOT NULL), i AS (SELECT pos, name, {_INTENT} AS intent, {_SURE} AS confidence FROM n)
        SELECT pos, intent, confidence, name || ' ' || CASE intent {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.TECHNICAL_WORDS.items())} END AS technical FROM i""",
    "text_table_fields": r"""WITH c AS (SELECT pos, content, list_filter(list_transform(regexp_extract_all(content, '\|\s*(\d+)\s*\|\s*([^\|]{3,50}?)\s*\|', 2),
          lambda x: regexp_replace(x, '^[\s　\x{a0}]+|[\s　\x{a0}]+$', '', 'g')), lambda x: length(x) > 1 AND NOT starts_with(x, '-')) AS names,
          regexp_extract_all(content, '(?m)^### [^\r\n]+?\(`([A-Z]{2}\d{7})`\)', 1) AS codes FROM chunks WHERE content IS NOT NULL),
        f AS (SELECT pos, CASE WHEN len(names) > 0 THEN names ELSE codes END AS f FROM c)
        SELECT pos, list_filter(f, lambda x, i: list_position(f, x) = i)[:20] AS fields FROM f""",
    "text_missing_values": r"""SELECT coalesce(name IS NULL OR regexp_replace(name, '^\s+|\s+$', '', 'g') IN ('nan', 'None', 'null', 'NaN') OR name = '', true) AS missing,
        count(*) AS nodes FROM graph_nodes GROUP BY 1""",
    "text_sections": r"""SELECT pos, regexp_extract(content, '\A## [^\r\n]+') AS leading,
        regexp_replace(regexp_extract(content, '(?m)^## ([^\r\n]*)', 1), '^[\s　\x{a0}]+|[\s　\x{a0}]+$', '', 'g') AS first FROM chunks WHERE content IS NOT NULL""",
    "file_inventory": f"""WITH f AS (SELECT source_file, sum(length(content)) AS size FROM chunks WHERE source_file IS NOT NULL GROUP BY 1),
        k AS (SELECT *, {_KIND} AS kind, {_NAME} AS name, string_split(source_file, '/')[1] AS folder FROM f), r AS (SELECT *, {_ROLE} AS role FROM k)
        SELECT source_file, kind, role, {_PARSER} AS parser FROM r""",
    "text_keywords": """SELECT item_id, list_sort(list_distinct(list_concat(list_concat(regexp_extract_all(text, '[一-鿿㐀-䶿]{2,}'), regexp_extract_all(text, '[゠-ヿ]{3,}')),
        regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_]+')))) AS search,
        array_to_string(list_concat(regexp_extract_all(text, '[　-鿿豈-﫿]+'), list_filter(regexp_extract_all(text, '[A-Za-z_][A-Za-z0-9_]*'), lambda x: length(x) > 1)), ' ') AS lexical FROM eval_items""",
}
