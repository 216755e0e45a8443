"""Files of a project as tables: scan, filter, decode, parse by type.

A scan reads names and sizes only; contents are read where a parser needs them, on the executors. One
file is one row, parsers run on Arrow batches and give rows of one shape, so their results are united.
"""

from __future__ import annotations

import csv
import html.parser
import io
import json
import re
import unicodedata
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import ids, rules
from folioscope.sources import mermaid

# Encodings tried in turn, languages of fenced code by extension, elements of pages that hold no content.
ENCODINGS = ("utf-8-sig", "utf-8", "cp932", "shift_jis", "euc_jp", "gb18030", "big5", "latin-1")
CODE_LANGUAGES = {"java": "java", "py": "python", "sql": "sql", "xml": "xml", "json": "json", "yaml": "yaml", "yml": "yaml", "properties": "properties", "sh": "bash", "bat": "batch", "js": "javascript", "css": "css", "ts": "typescript", "go": "go", "rb": "ruby", "c": "c", "cpp": "cpp", "cs": "csharp"}
NO_CONTENT = ("script", "style", "nav", "header", "footer", "noscript", "iframe", "meta")


def scan(spark: SparkSession, path: str, project: str, *, glob: str | None = None) -> DataFrame:
    """Inventory of a tree (local or object store): path, size, type, role, parser; junk and empty files left out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select(F.col("path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    root = re.sub(r"^file:/*|^[a-z0-9]+://", "", path).strip("/")
    relative = F.regexp_replace(F.regexp_replace("path", r"^[a-z0-9]+:/*", ""), f"^/*{re.escape(root)}/*", "")
    out = files.withColumn("relative_path", relative).filter((F.col("size_bytes") > 0) & ~rules.is_skipped(F.col("relative_path")))
    name = rules.file_name(F.col("relative_path"))
    out = out.filter(~name.startswith(".") & ~name.startswith("~$")).withColumn("project_id", F.lit(project))
    out = out.withColumn("parent_folder", F.regexp_extract("relative_path", r"^(?:.*/)?([^/]+)/[^/]+$", 1)).withColumn("source_type", rules.file_type(F.col("relative_path")))
    role = rules.document_role(F.col("relative_path"), F.col("parent_folder"), F.col("source_type"), F.col("size_bytes"))
    out = out.withColumn("document_role", role).withColumn("p_", rules.parser_choice(F.col("relative_path"), F.col("source_type"), F.col("document_role")))
    return out.withColumns({"parser_type": F.col("p_.parser"), "skip_reason": F.col("p_.skip_reason"), "doc_id": ids.document_id(F.lit(project), F.col("relative_path"))}).drop("p_")


def discover(inventory: DataFrame, *, types: list[str] | None = None, folder: str | None = None, pattern: str | None = None) -> DataFrame:
    """Files of the types, under a folder, by a glob on the name."""
    out = inventory
    if types:
        out = out.filter(F.col("source_type").isin(types))
    if folder:
        out = out.filter(F.col("relative_path").contains(folder))
    if pattern:
        import fnmatch

        out = out.filter(rules.file_name(F.col("relative_path")).rlike(fnmatch.translate(pattern).replace("(?s:", "(?s:").replace("\\Z", "$")))
    return out


VISION = ("pdf_vlm", "image_vlm", "excel_vlm", "doc_vlm")


def pending(inventory: DataFrame, parsed: DataFrame | None = None, *, vision: bool = True, force: bool = False, limit: int | None = None) -> DataFrame:
    """Files still to parse: no skipped ones, without those parsed already unless forced, the first ``limit`` by path."""
    out = inventory.filter(~F.col("parser_type").isin("skip", "mermaid"))
    if not vision:
        out = out.filter(~F.col("parser_type").isin(*VISION))
    if parsed is not None and not force:
        out = out.join(parsed.select("doc_id"), "doc_id", "left_anti")
    return out if limit is None else out.orderBy("relative_path").limit(limit)


def decode(raw: bytes) -> str:
    """Bytes as text: by the byte order mark, else by the first encoding that fits."""
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return raw.decode("utf-16", "replace")
    for name in ENCODINGS:
        try:
            return raw.decode(name)
        except UnicodeError:
            continue
    return raw.decode("utf-8", "replace")


def safe_name(relative: str, most: int = 120) -> str:
    """A file name for the parsed document: NFC, the last two parts joined, the extension kept as a suffix."""
    parts = unicodedata.normalize("NFC", relative).split("/")[-2:]
    name = re.sub(r'[\\:*?"<>|\s]+', "_", "__".join(parts))
    stem, dot, ext = name.rpartition(".")
    return ((stem if dot else name)[:most]) + (f"_{ext.lower()}" if dot else "")


# -- front matter -----------------------------------------------------------------------------------------------------------------


def front_matter(text: str) -> tuple[dict, str]:
    """(fields, body). What is no closed block of YAML fields stays in the body."""
    if not text.startswith("---\n"):
        return {}, text
    end = text.find("\n---\n", 4)
    if end < 0:
        return {}, text
    try:
        import yaml

        fields = yaml.safe_load(text[4:end])
    except Exception:
        return {}, text
    if not isinstance(fields, dict):
        return {}, text
    return fields, text[end + 5 :].lstrip("\n")


def _plain(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False, default=str)


def with_front_matter(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``fields`` (map of strings) and ``body``."""

    @F.pandas_udf("fields map<string,string>, body string")
    def split(texts):
        import pandas as pd

        done = [front_matter(t or "") for t in texts]
        return pd.DataFrame({"fields": [{str(k): _plain(v) for k, v in f.items()} for f, _ in done], "body": [b for _, b in done]})

    return docs.withColumn("s_", split(F.col(text))).withColumns({"fields": F.col("s_.fields"), "body": F.col("s_.body")}).drop("s_")


def checked_project(docs: DataFrame, project: str) -> DataFrame:
    """Documents whose front matter names another project stop the run."""
    other = F.coalesce(F.try_element_at("fields", F.lit("project_id")), F.lit(project)) != project
    return docs.withColumn("project_id", F.when(F.assert_true(~other, F.concat(F.lit("front matter names another project than "), F.lit(project))).isNull(), F.lit(project)))


# -- parsers: bytes of one file to Markdown ---------------------------------------------------------------------------------------


class _Page(html.parser.HTMLParser):
    """Markdown of a page's content: headings, paragraphs, lists, tables, code."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.out, self.skip, self.lists, self.cells, self.rows, self.pre = "", [], 0, [], None, None, False
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        if tag in NO_CONTENT and tag != "meta":
            self.skip += 1
        elif tag == "title":
            self.in_title = True
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "section", "article", "main"):
            self.out.append("\n\n")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n")
        elif tag == "li":
            level = self.lists[-1] if self.lists else ["ul", 0]
            level[1] += 1
            self.out.append("\n" + "  " * (len(self.lists) - 1) + (f"{level[1]}. " if level[0] == "ol" else "- "))
        elif tag == "br":
            self.out.append("\n")
        elif tag == "pre":
            self.pre = True
            self.out.append("\n\n```\n")
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag == "table":
            self.rows = []
        elif tag == "tr" and self.rows is not None:
            self.cells = []
        elif tag in ("td", "th") and self.cells is not None:
            self.cells.append("")

    def handle_endtag(self, tag):
        if tag in NO_CONTENT and tag != "meta":
            self.skip = max(0, self.skip - 1)
        elif tag == "title":
            self.in_title = False
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("\n")
        elif tag == "pre":
            self.pre = False
            self.out.append("\n```\n")
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag == "tr" and self.cells is not None:
            self.rows.append(self.cells)
            self.cells = None
        elif tag == "table" and self.rows is not None:
            self.out.append("\n\n" + pipe_table(self.rows) + "\n\n")
            self.rows = None

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.skip:
            if self.cells:
                self.cells[-1] += re.sub(r"\s+", " ", data)
            elif self.rows is None:
                self.out.append(data if self.pre else re.sub(r"\s+", " ", data))


def pipe_table(rows: list[list[str]]) -> str:
    """A pipe table, rows padded or cut to the head's width."""
    if not rows:
        return ""
    width = len(rows[0])
    line = lambda r: "| " + " | ".join([c.strip().replace("|", "\\|").replace("\n", " ") for c in [*r, *[""] * width][:width]]) + " |"
    return "\n".join([line(rows[0]), "|" + "---|" * width, *map(line, rows[1:])])


def parse_html(raw: bytes, path: str) -> tuple[str, str]:
    text = decode(raw)
    page = _Page()
    body = re.search(r"(?is)<(main|article)\b.*?</\1>", text)
    title = re.search(r"(?is)<title[^>]*>(.*?)</title>", text)
    page.feed(body[0] if body else text)
    markdown = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", "".join(page.out))).strip()
    return (re.sub(r"\s+", " ", title[1]).strip() if title else page.title.strip()) or path.rpartition("/")[2], markdown


def parse_code(raw: bytes, path: str) -> tuple[str, str]:
    name = path.rpartition("/")[2]
    language = CODE_LANGUAGES.get(name.rpartition(".")[2].lower(), "")
    return name, f"# {name}\n\n```{language}\n{decode(raw)}\n```"


def parse_markdown(raw: bytes, path: str) -> tuple[str, str]:
    text = decode(raw)
    title = re.search(r"(?m)^# (.+)$", text)
    return title[1].strip() if title else path.rpartition("/")[2].rpartition(".")[0], text


def parse_text(raw: bytes, path: str) -> tuple[str, str]:
    stem = path.rpartition("/")[2].rpartition(".")[0]
    return stem, f"# {stem}\n\n{decode(raw)}"


# Words that mark a head row, and words of tables of contents and change histories.
HEAD_WORDS = ("項目名", "項目記号", "桁数", "種別", "必須", "受入", "出力", "名称出力", "抽出", "並び順", "備考")
CONTENTS_WORDS = ("ページ", "項目名", "変更内容")


def csv_layout(rows: list[list[str]]) -> tuple[str, int]:
    """(layout, head row): an API specification, a change history, another table with a known head, or free text (-1)."""
    for i, row in enumerate(rows[:20]):
        cells = {c.strip() for c in row}
        if len(cells & set(HEAD_WORDS)) >= 3:
            return ("api" if "桁数" in cells else "table"), i
        if len(cells & set(CONTENTS_WORDS)) >= 2:
            return "history", i
    return "free", -1


def _fields(head: list[str], row: list[str]) -> list[tuple[str, str]]:
    return [(h.strip(), c.strip()) for h, c in zip(head, row) if h.strip() and c.strip()]


def parse_csv(raw: bytes, path: str) -> tuple[str, str]:
    """Rows as text, all columns strings, in the layout the head row tells. 【...】 rows become sections.

    An API specification gives a heading and a list per field, and rows that only continue a remark are added to it;
    a change history gives a line per change; other tables stay tables; rows without a known head are prose, or, where
    all rows are equally wide, a table with the first row as its head."""
    text, stem = decode(raw), path.rpartition("/")[2].rpartition(".")[0]
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter="\t" if path.lower().endswith(".tsv") else ",") if any(c.strip() for c in r)]
    if not rows:
        return stem, f"# {stem}"
    layout, at = csv_layout(rows)
    if layout == "free" and len(rows) > 1 and len({len(r) for r in rows}) == 1 and len(rows[0]) > 1 and all(c.strip() for c in rows[0]):
        layout, at = "table", 0
    title = next((c.strip() for r in rows[: min(5, max(at, 0))] for c in r if c.strip() and not c.strip().startswith("【")), stem)
    head = rows[at] if at >= 0 else []
    out, table = [f"# {title}"], []

    def close() -> None:
        if table:
            out.append(pipe_table([head, *table]))
            table.clear()

    for i, row in enumerate(rows):
        given = [c.strip() for c in row if c.strip()]
        section = re.fullmatch(r"【(.+?)】", given[0]) if len(given) == 1 else None
        if section:
            close()
            out.append(f"## {section[1]}")
        elif i == at or (i < at and given == [title]):
            continue
        elif i < at or layout == "free":
            out.append(" ".join(given))
        elif layout == "api":
            if not row[0].strip() and len(given) == 1 and out[-1].startswith("### "):
                out[-1] += " " + given[0]
            else:
                name, *rest = _fields(head, row) or [("", given[0])]
                out.append("\n".join([f"### {name[1]}", *(f"- {h}: {c}" for h, c in rest)]))
        elif layout == "history":
            out.append("- " + ", ".join(f"{h}: {c}" for h, c in _fields(head, row)))
        else:
            if table and not row[0].strip() and len(given) == 1:
                place = next(n for n, c in enumerate(row) if c.strip())
                table[-1] = [*table[-1], *[""] * (place + 1)][: max(len(table[-1]), place + 1)]
                table[-1][place] = (table[-1][place] + " " + given[0]).strip()
            else:
                table.append(row)
    close()
    return title, "\n\n".join(out)


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def parse_docx(raw: bytes, path: str) -> tuple[str, str]:
    """Paragraphs and tables of a document in the order of its body."""
    if not zipfile.is_zipfile(io.BytesIO(raw)):
        raise ValueError("no zipped document (an old binary .doc needs a converter)")
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
        images = sum(n.startswith("word/media/") for n in z.namelist())
    out, stem = [], path.rpartition("/")[2].rpartition(".")[0]
    text_of = lambda e: "".join(t.text or "" for t in e.iter(f"{_W}t"))
    for e in body if body is not None else ():
        if e.tag == f"{_W}p":
            style = e.find(f"{_W}pPr/{_W}pStyle")
            style = (style.get(f"{_W}val") or "") if style is not None else ""
            text = text_of(e).strip()
            level = re.match(r"(?i)heading\s*(\d)?", style)
            if text and level:
                n = int(level[1] or 4)
                out.append("#" * (n if n <= 3 else 4) + " " + text)
            elif text:
                out.append(("- " if "list" in style.lower() or e.find(f"{_W}pPr/{_W}numPr") is not None else "") + text)
        elif e.tag == f"{_W}tbl":
            out.append(pipe_table([[text_of(c) for c in r.findall(f"{_W}tc")] for r in e.findall(f"{_W}tr")]))
    if images:
        out.append(f"*{images} images*")
    return stem, "\n\n".join(out)


def parse_mermaid(raw: bytes, path: str) -> tuple[str, str]:
    text, stem = decode(raw), path.rpartition("/")[2].rpartition(".")[0]
    return stem, mermaid.to_markdown(stem, mermaid.parse(text), text)


#: The parser of each kind; a kind without one needs a model or a library and is reported, see ``parse_files``.
PARSERS: dict[str, Callable[[bytes, str], tuple[str, str]]] = {
    "html": parse_html, "code": parse_code, "markdown": parse_markdown, "text": parse_text, "csv": parse_csv, "docx": parse_docx, "mermaid": parse_mermaid,
}

PARSED = "doc_id string, title string, content_markdown string, error string"


def parse_files(spark: SparkSession, files: DataFrame, *, more: dict[str, Callable[[bytes, str], tuple[str, str]]] | None = None) -> DataFrame:
    """Inventory rows parsed: doc_id, title, content_markdown, error, with the content's hash, state and language.

    ``more`` adds or replaces parsers by name, such as those that call a model for scans and sheets. A file that
    cannot be parsed keeps its row with the error, it is not dropped. Contents are read by path, one file a row.
    """
    known = PARSERS | (more or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            out = []
            for doc, path, kind, raw in zip(col["doc_id"], col["path"], col["parser_type"], col["content"]):
                try:
                    if kind not in known:
                        raise ValueError(f"no parser for {kind} here")
                    out.append((doc, *known[kind](raw or b"", path), ""))
                except Exception as e:
                    out.append((doc, "", "", f"{type(e).__name__}: {e}"[:500]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)] if out else [pa.array([], pa.string())] * 4, names=["doc_id", "title", "content_markdown", "error"])

    from folioscope.functions.text import language_by_count

    paths = [r.path for r in files.select("path").distinct().limit(2).collect()]
    if not paths:
        return spark.createDataFrame([], PARSED + ", content_hash string, state string, language string")
    roots = [r.root for r in files.select(F.regexp_replace("path", r"/[^/]+$", "").alias("root")).distinct().collect()]  # folders, not files
    content = spark.read.format("binaryFile").load(roots).select("path", "content")
    rows = files.select("doc_id", "path", "parser_type").join(content, "path")
    parsed = rows.select("doc_id", "path", "parser_type", "content").mapInArrow(run, PARSED)
    text = F.col("content_markdown")
    return parsed.withColumns({"content_hash": ids.short_hash(text, 16), "state": F.when(F.col("error") == "", "parsed").otherwise("parse_failed"), "language": language_by_count(text)})
