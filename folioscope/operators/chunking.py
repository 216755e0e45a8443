"""Splitting Markdown documents into chunks with provenance.

The splitters are order-dependent automata over lines, so they run in Python on Arrow batches, one
document a row, no shuffle. Everything that can be said of a chunk afterwards (ids, hashes, type,
section, systems, fields) is a JVM-side expression on the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import ids, rules
from folioscope.functions import text as tx

_VERSION = re.compile(r"## Ver.+変更", re.IGNORECASE)
_META = re.compile(r"\*\*.+\*\*")
_TABLE = re.compile(r"\|.+\|")


def _starts_structure(line: str) -> bool:
    return bool(re.match(r"#{1,3} .", line) or _TABLE.match(line) or line.startswith(("```", "> ")))


def blocks(markdown: str) -> list[tuple[str, str]]:
    """(kind, text): title, version, section, field, table, code, quote, meta and text blocks in order.

    Titles and meta lines exist only before the first section. A fence without its end runs to the end; a field
    block runs to the next heading and swallows what lies inside; a version block runs to the next section.
    """
    lines, out, i, in_body = markdown.split("\n"), [], 0, False

    def run(while_: re.Pattern | None, begin: int, stop=None) -> int:
        j = begin
        while j < len(lines) and (while_.match(lines[j]) if while_ else not stop(lines[j])):
            j += 1
        return j

    while i < len(lines):
        line = lines[i]
        if not line.strip():
            i += 1
            continue
        if line.startswith("```"):
            j = run(None, i + 1, lambda x: x.startswith("```"))
            j, kind = min(j + 1, len(lines)), "code"
        elif line.startswith("# ") and not in_body:
            j, kind = i + 1, "title"
        elif _VERSION.match(line):
            j, kind = run(None, i + 1, lambda x: x.startswith(("## ", "# "))), "version"
        elif line.startswith("## ") and line[3:].strip():
            j, kind, in_body = i + 1, "section", True
        elif line.startswith("### ") and line[4:].strip():
            j, kind = run(None, i + 1, lambda x: x.startswith(("### ", "## ", "# "))), "field"
        elif _TABLE.match(line):
            j, kind = run(_TABLE, i + 1), "table"
        elif line.startswith("> "):
            j, kind = run(re.compile("> "), i + 1), "quote"
        elif _META.match(line) and not in_body:
            j, kind = i + 1, "meta"
        else:
            j, kind = run(None, i + 1, lambda x: not x.strip() or _starts_structure(x)), "text"
        out.append((kind, "\n".join(lines[i:j]).strip("\n")))
        i = j
    return out


def _pack(items: list[str], limit: int, glue: str, first: int = 0) -> list[list[str]]:
    """Items in order in bins of at most ``limit`` characters (a longer item has a bin of its own)."""
    bins: list[list[str]] = []
    size = first
    for item in items:
        if bins and bins[-1] and size + len(item) + len(glue) > limit:
            bins.append([])
            size = first
        if not bins:
            bins.append([])
        bins[-1].append(item)
        size += len(item) + len(glue)
    return bins


def split_large(text: str, most: int, least: int, header: str = "") -> list[str]:
    """A text over the limit, by paragraphs, or by lines where paragraphs are few or too long; pieces repeat the header."""
    paragraphs = [p.strip() for p in re.split(r"\n\s*\n", text) if p.strip()]
    head = f"{header}\n\n" if header else ""
    if (len(paragraphs) <= 2 and len(text) > most) or any(len(p) + len(head) > most for p in paragraphs):
        items, glue, limit, first = text.split("\n"), "\n", most, len(head)
    else:
        items, glue, limit, first = paragraphs, "\n\n", most - len(head), 0
    out = []
    for part in _pack(items, limit, glue, first):
        body = glue.join(part).strip()
        piece = body if not head or part[0].startswith("## ") else head + body
        if len(piece) > most and len(body) <= most:
            piece = body
        if len(piece) >= least:
            out.append(piece)
    return out


def semantic_chunks(markdown: str, most: int = 4000, least: int = 100, target: int = 2000) -> list[str]:
    """Blocks packed up to ``target``, a section's heading repeated when the section goes on in another chunk.

    Pieces under ``least`` are dropped, unless nothing else is left of the document."""
    out: list[str] = []
    buffer: list[str] = []
    size, header = 0, ""

    def flush() -> None:
        nonlocal size
        joined = "\n\n".join(buffer).strip()
        if len(joined) >= least:
            out.append(joined)
        buffer.clear()
        size = 0

    def push(text: str) -> None:
        nonlocal size
        buffer.append(text)
        size += len(text) + 2

    for kind, text in blocks(markdown):
        if kind == "section":
            flush()
            header = text
            push(text)
        elif kind == "version":
            flush()
            out.extend(split_large(text, most, least) if len(text) > most else [text] if len(text) >= least else [])
        elif len(text) > most:
            flush()
            out.extend(split_large(text, most, least, header))
        else:
            headed = text.startswith(("## ", "# "))
            if header and not buffer and not headed:
                push(header)
            if buffer and size + len(text) + 2 > target:
                flush()
                if header and not headed:
                    push(header)
            push(text)
    flush()
    whole = markdown.strip()
    return out or ([whole] if len(whole) >= least else [])


def fixed_chunks(markdown: str, most: int = 2000, least: int = 100) -> list[str]:
    """Sections of the first three levels; larger ones are cut at an empty line outside tables once they reach the limit,
    and a short rest joins the piece before if both stay within one and a half limits."""
    out: list[str] = []
    for section in re.split(r"(?m)^(?=#{1,3} )", markdown):
        text = section.strip()
        if len(text) <= most:
            out += [text] if len(text) >= least else []
            continue
        pieces, current, size = [], [], 0
        for line in text.split("\n"):
            if not line.strip() and size >= most and not (current and _TABLE.match(current[-1])):
                pieces.append("\n".join(current).strip())
                current, size = [], 0
            else:
                current.append(line)
                size += len(line) + 1
        rest = "\n".join(current).strip()
        if rest and pieces and len(rest) < least and len(pieces[-1]) + len(rest) <= 1.5 * most:
            pieces[-1] += "\n\n" + rest
        elif rest:
            pieces.append(rest)
        out += [p for p in pieces if len(p) >= least]
    return out


# -- Mermaid documents --------------------------------------------------------------------------------------------------------

# The sections of a Mermaid document and the label of their chunks.
MERMAID_SECTIONS = (
    ("overview", "overview"), ("functional modules", "module"), ("nodes", "node_table"), ("edges", "edge_table"), ("decision points", "decision"),
    ("business flow", "business_flow"), ("original mermaid source", "source"),
)


def mermaid_chunks(markdown: str, most: int = 4000, target: int = 2000) -> list[tuple[str, str]]:
    """(label, text): modules grouped, tables cut at rows with their head repeated, decisions, flow steps; the source is left out."""
    parts = re.split(r"(?m)^(?=#{2,3} )", markdown)
    found: dict[str, str] = {}
    for part in parts:
        title = part.split("\n", 1)[0].lstrip("# ").strip().lower()
        for name, label in MERMAID_SECTIONS:
            if title.startswith(name) and label not in found:
                found[label] = part.strip()
    lead = parts[0].strip()
    if lead and "overview" not in found:
        found["overview"] = lead
    out: list[tuple[str, str]] = []
    for label, text in found.items():
        if label == "source":
            continue
        if label in ("node_table", "edge_table"):
            lines = text.split("\n")
            table = [x for x in lines if _TABLE.match(x)]
            head, rows = table[:2], table[2:]
            top = "\n".join([lines[0], "", *head])
            out += [(label, top + "\n" + "\n".join(b)) for b in _pack(rows, max(1, most - len(top)), "\n")] if rows else [(label, text)]
        elif label in ("module", "business_flow"):
            cut = r"(?m)^(?=\d+\. )" if label == "business_flow" else r"(?m)^(?=#{4} |- \*\*)"
            title, *items = [x.strip() for x in re.split(cut, text) if x.strip()]
            out += [(label, "\n\n".join([title, *b])) for b in _pack(items, target, "\n\n", len(title))] if items else [(label, text)]
        else:
            out += [(label, p) for p in (split_large(text, most, 1) if len(text) > most else [text])]
    return out or [("overview", markdown.strip())]


# -- on tables ----------------------------------------------------------------------------------------------------------------

PARTS = "key string, parts array<struct<no: int, label: string, text: string>>"


def _splitter(most: int | None, least: int, target: int):
    kind = pa.list_(pa.struct([("no", pa.int32()), ("label", pa.string()), ("text", pa.string())]))

    def one(strategy: str, text: str):
        if strategy == "semantic":
            return [("", t) for t in semantic_chunks(text, most or 4000, least, target)]
        if strategy == "fixed":
            return [("", t) for t in fixed_chunks(text, most or 2000, least)]
        if strategy == "mermaid":
            return mermaid_chunks(text, most or 4000, target)
        return [("", text.strip())] if text.strip() else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                [{"no": i, "label": label, "text": t} for i, (label, t) in enumerate(one(s, text or ""))]
                for s, text in zip(batch.column("strategy").to_pylist(), batch.column("body").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, kind)], names=["key", "parts"])

    return run


def strategy(source_type, parser=None):
    """Which splitter a document gets: Mermaid documents, single-chunk kinds, else the default."""
    kind = F.lower(source_type)
    mermaid = kind == "mermaid"
    if parser is not None:
        mermaid = mermaid | (F.lower(parser) == "mermaid")
    return F.when(mermaid, "mermaid").when(kind.isin("image", "images"), "single").otherwise(F.lit("semantic"))


def chunk_documents(docs: DataFrame, *, key: str, body: str, strategy: str, most: int | None = None, least: int = 100, target: int = 2000) -> DataFrame:
    """(key, chunk_index, label, content) of every document, by the splitter its ``strategy`` column names."""
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(strategy).alias("strategy"), F.coalesce(F.col(body), F.lit("")).alias("body"))
    cut = rows.mapInArrow(_splitter(most, least, target), PARTS)
    return cut.select("key", F.inline("parts")).select("key", F.col("no").alias("chunk_index"), "label", F.col("text").alias("content"))


def described(chunks: DataFrame, *, source_type, document, sheet_name) -> DataFrame:
    """Chunks with their derived columns: ids, hash, type, section, systems, APIs, fields, text to embed."""
    t = F.col("content")
    digest, systems = ids.content_hash(t), tx.found_systems(t)
    kind = rules.chunk_type(t, sheet_name)
    head = F.concat(F.lit("ソース: "), document, F.lit(" | タイプ: "), kind, F.when(F.size(systems) > 0, F.concat(F.lit(" | システム: "), F.array_join(systems, ", "))).otherwise(""), F.lit("\n\n"))
    return chunks.withColumns({
        "content_hash": digest, "chunk_id": ids.chunk_id(source_type, document, ids.unit_label(sheet_name), F.col("chunk_index"), digest), "chunk_type": kind,
        "section_name": tx.first_section(t), "systems": systems, "apis": tx.found_apis(t), "fields": tx.found_fields(t), "field_codes": tx.field_codes(t),
        "embedding_text": F.concat(head, t),
    })


def evidence_units(docs: DataFrame, *, key: str, text: str, most: int | None = None) -> DataFrame:
    """Sections at headings of the first four levels with their line range (from 0) and whole text, cut to ``most`` characters only if given.

    The section's number is a running count of headings over the document's lines; its kind is that of the whole text.
    Where a key is repeated, lines of one number count as one place: all headings of that place count for each of them.
    """
    from pyspark.sql import Window

    lines = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("line", "content"))
    heading = F.col("content").rlike(r"^#{1,4}[\t\n\f\r ]+")  # the blanks of SQL's \s; Java's has the vertical tab too
    counted = lines.withColumn("section", F.sum(heading.cast("int")).over(Window.partitionBy("key").orderBy("line").rangeBetween(Window.unboundedPreceding, 0)))
    out = counted.groupBy("key", "section").agg(
        F.min("line").alias("line_start"), F.max("line").alias("line_end"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "content"))), lambda x: x["content"]), "\n").alias("content"),
    )
    bare = F.regexp_replace("content", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")  # separators are blanks too, as in the SQL
    out = out.withColumn("content", bare).filter("content <> ''").withColumn("kind", rules.evidence_kind(F.col("content")))
    return out if most is None else out.withColumn("content", F.substring("content", 1, most))


def mentions_together(docs: DataFrame, *, key: str, text: str, pattern: str) -> DataFrame:
    """(a, b): two different matches of a pattern that share a paragraph, in both directions."""
    p = docs.filter(F.col(text).isNotNull()).select(F.explode(F.split(F.col(text), r"\n\s*\n")).alias("paragraph"))
    found = p.select(F.array_distinct(tx.all_matches(F.col("paragraph"), pattern)).alias("m")).filter(F.size("m") > 1).distinct()
    return found.select(F.explode("m").alias("a"), "m").select("a", F.explode("m").alias("b")).filter("a <> b").distinct()
