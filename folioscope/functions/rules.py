"""Classification by ordered rules, compiled to one CASE expression (the first rule that fits decides)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(c: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def first_match(rules: Sequence[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def by_keywords(c: Column, rules: Sequence[tuple[str, Sequence[str]]], otherwise: str) -> Column:
    """The first label of which a keyword occurs in the text, in any case."""
    text = F.lower(c)
    return first_match([(contains_any(text, [w.lower() for w in words]), F.lit(label)) for label, words in rules], F.lit(otherwise))


# Chunk types and their keywords, in order.
CHUNK_TYPES = (
    ("flowchart", ("flowchart", "フローチャート", "API呼出順序", "api call", "sequence", "flow")),
    ("data_condition", ("データ取得条件", "data condition", "取得条件", "where clause", "抽出条件")),
    ("business_rule", ("business rule", "ビジネスルール", "条件", "注意事項", "補足", "special", "注記")),
    ("api_spec", ("api", "endpoint", "REST", "HTTP", "GET", "POST", "PUT", "DELETE", "request", "response")),
    ("mapping_table", ("マッピング", "mapping", "フィールド", "field", "項目名", "送信元", "送信先")),
    ("overview", ("overview", "概要", "document", "change history", "変更履歴", "summary", "一覧")),
)


def chunk_type(text: Column, sheet_name: Column | None = None) -> Column:
    both = text if sheet_name is None else F.concat_ws(" ", text, F.coalesce(sheet_name, F.lit("")))
    return by_keywords(both, CHUNK_TYPES, "overview")


# Kinds of sheets by the words of their text, in order.
SHEET_KINDS = (
    ("overview", ("変更履歴", "change history", "表紙", "cover")),
    ("overview", ("目次", "table of contents")),
    ("flowchart", ("```mermaid", "flowchart td", "flowchart lr", "フローチャート", "function modules", "decision points", "main process flow")),
    ("api_call_sequence", ("api呼出順序", "api call sequence", "api呼出", "call order")),
    ("mapping_sheet", ("マッピング", "mapping rules", "source table", "target table", "mapping sheet", "field mapping")),
    ("api_request_response_spec", ("apiデータ形式", "api data format", "request", "response", "endpoint", "rest")),
    ("middleware_development_spec", ("スクリプト", "script", "フロー図", "flow diagram")),
    ("test_spec", ("試験", "test", "テスト")),
    ("review_record", ("レビュー", "review")),
    ("data_retrieval_condition", ("取得条件", "retrieval condition", "data retrieval", "抽出条件", "filter")),
    ("conversion_rule", ("変換", "conversion", "コード変換")),
    ("overview", ("概要", "overview", "summary")),
    ("implementation_spec", ("仕様", "specification", "設定")),
)


def sheet_kind(text: Column, *, parity: bool = False) -> Column:
    """By the whole text; with ``parity`` by the first 3000 and 5000 characters, as the reference reads the two together."""
    read = F.concat_ws(" ", F.substring(text, 1, 3000), F.substring(text, 1, 5000)) if parity else text
    return by_keywords(read, SHEET_KINDS, "unknown")


def sheet_tab_kind(sheet: Column, workbook: Column) -> Column:
    """The kind of a sheet by its tab and its workbook's name."""
    both = F.concat_ws(" ", sheet, workbook)
    return first_match(
        [
            (sheet.contains("変更履歴"), F.lit("change_history")),
            (both.contains("API") & both.contains("順序"), F.lit("flowchart")),
            (both.contains("フローチャート"), F.lit("flowchart")),
            (both.contains("開発仕様"), F.lit("dev_spec")),
            (sheet.contains("データ取得条件"), F.lit("data_condition")),
            (both.contains("マッピングシート") | (both.contains("マッピング") & both.contains("定義書")), F.lit("mapping")),
            (sheet.contains("補足事項"), F.lit("supplementary")),
        ],
        F.lit("generic"),
    )


# Words that set an inventory flag, in the case given.
FLAG_WORDS = {
    "has_mermaid": ("```mermaid", "flowchart TD", "flowchart LR"),
    "has_mapping_table": ("Source Table", "Target Table", "マッピング", "Mapping Rules", "Source Field", "Target Field", "ソーステーブル", "ターゲットテーブル"),
    "has_api_table": ("API", "endpoint", "HTTP", "REST", "request", "response", "APIデータ形式", "API呼出"),
    "has_business_rules": ("Business Rule", "ビジネスルール", "条件", "Condition", "変換ルール", "Conversion", "TransformationRule"),
    "has_uncertain": ("Uncertain", "Ambiguous", "不明", "未確定", "要確認"),
}


def inventory_flags(text: Column) -> dict[str, Column]:
    return {name: contains_any(text, words) for name, words in FLAG_WORDS.items()}


def evidence_kind(text: Column) -> Column:
    """mermaid, table (more than four pipes) or section."""
    return F.when(text.contains("```mermaid"), "mermaid").when(F.regexp_count(text, F.lit(r"\|")) > 4, "table").otherwise("section")


# File types by extension.
FILE_TYPES = {
    "excel_sheet": (".xlsx", ".xls", ".xlsm"), "pdf_native": (".pdf",), "docx": (".docx", ".doc"), "pptx": (".pptx",), "csv": (".csv", ".tsv"),
    "code": (".java", ".py", ".sql", ".xml", ".json", ".yaml", ".yml", ".properties", ".sh", ".bat"), "markdown": (".md",),
    "mermaid": (".mmd", ".mermaid"), "image": (".png", ".jpg", ".jpeg", ".gif", ".tiff", ".bmp"), "html": (".html", ".htm"), "plaintext": (".txt", ".log"),
}
SKIPPED_FILES, SKIPPED_PREFIXES = ("thumbs.db", ".ds_store", "desktop.ini", ".gitkeep"), ("__macosx", "~$")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_type(path: Column) -> Column:
    name = F.lower(file_name(path))
    extension = F.regexp_extract(name, r".(\.[^.]+)$", 1)
    known = [(extension.isin(*extensions), F.lit(kind)) for kind, extensions in FILE_TYPES.items()]
    hidden = [(name.startswith(p), F.lit("unknown")) for p in SKIPPED_PREFIXES]
    return first_match([*hidden, *known], F.lit("unknown"))


def is_skipped(path: Column) -> Column:
    name = F.lower(file_name(path))
    return name.isin(*SKIPPED_FILES) | name.startswith(SKIPPED_PREFIXES[0]) | name.startswith(SKIPPED_PREFIXES[1])


# Roles by the file's name, then by its folder; a rule list of one's own may replace them.
NAME_ROLES = (
    ("合同|contract|契約", "contract"), ("验收|受入", "contract"), ("报价|見積|quotation", "contract"), ("保密|confidential|nda", "contract"), ("外包", "contract"),
    (r"テスト|测试|test.*case", "test_case"), ("IF-[A-Z0-9]+|IF_[A-Z0-9]+", "specification"), ("设计|design|仕様|式样|specification|spec", "design_doc"),
    ("Inventory", "data_sample"), (r"jquery|\.min\.(js|css)$", "asset"), (r"\.(css|js)$", "configuration"), (r"index\.html?$", "specification"),
)
FOLDER_ROLES = (
    ("合同", "contract"), ("验收申请|受入申請", "contract"), ("测试报告|テスト報告|test.*report", "test_case"), (r"设计_\d+|設計", "design_doc"),
    ("IF.*式样|IF.*仕様", "data_mapping"), ("assets", "asset"),
)
TYPE_ROLES = {
    "html": "specification", "mermaid": "process_flow", "markdown": "specification", "code": "configuration", "csv": "data_sample",
    "excel_sheet": "data_sample", "pdf_native": "contract", "docx": "contract",
}


def document_role(path: Column, folder: Column, kind: Column, size: Column, names=NAME_ROLES, folders=FOLDER_ROLES) -> Column:
    """The role of a file in a project, by ordered rules."""
    name = file_name(path)
    return first_match(
        [
            ((kind == "image") & (size < 10_240), F.lit("asset")),
            ((kind == "image") & F.lower(folder).contains("assets"), F.lit("screenshot")),
            (F.lower(name).contains(".min.js") | F.lower(name).contains(".min.css"), F.lit("asset")),
            *[(name.rlike(f"(?iU){p}"), F.lit(role)) for p, role in names],
            *[(folder.rlike(f"(?iU){p}"), F.lit(role)) for p, role in folders],
            *[(kind == k, F.lit(role)) for k, role in TYPE_ROLES.items()],
        ],
        F.lit("unknown"),
    )


def parser_choice(path: Column, kind: Column, role: Column) -> Column:
    """struct(parser, skip_reason): which parser reads a file, or why none does."""
    low = F.lower(path)
    pick = lambda parser, reason="": F.struct(F.lit(parser).alias("parser"), F.lit(reason).alias("skip_reason"))
    loose_code = low.rlike(r"\.(js|css|properties)$")
    return first_match(
        [
            (kind == "excel_sheet", pick("excel_vlm")), (kind == "pdf_native", pick("pdf_vlm")),
            ((kind == "docx") & low.endswith(".doc"), pick("doc_vlm")), (kind == "docx", pick("docx")), (kind == "csv", pick("csv")),
            (kind == "mermaid", pick("mermaid", "handled by the mermaid parser")), (kind == "markdown", pick("markdown")), (kind == "html", pick("html")),
            ((kind == "image") & (role == "asset"), pick("skip", "small icon or asset")), (kind == "image", pick("image_vlm")),
            ((kind == "code") & low.contains(".min."), pick("skip", "minified asset")), (kind == "code", pick("code")),
            ((kind == "unknown") & loose_code & low.contains(".min."), pick("skip", "minified asset")), ((kind == "unknown") & loose_code, pick("code")),
            (kind == "unknown", pick("skip", "unknown file type")), (kind == "plaintext", pick("text")),
        ],
        pick("skip", "no parser for this type"),
    )


# Intents of a query and their keywords, in order.
INTENTS = {
    "mapping": ("マッピング", "mapping", "変換", "transform", "対応表", "対応"),
    "flowchart": ("フロー", "flow", "シーケンス", "sequence", "手順", "処理順序", "呼出順序"),
    "api": ("API", "api", "endpoint", "呼出", "インターフェース", "interface", "リクエスト", "レスポンス"),
    "field": ("フィールド", "field", "項目", "カラム", "column", "データ項目"),
    "rule": ("ルール", "rule", "条件", "condition", "ビジネスルール", "判定", "分岐"),
    "overview": ("概要", "overview", "全体", "summary", "一覧", "構成"),
}


def keyword_hits(c: Column, words: Sequence[str]) -> Column:
    text = F.lower(c)
    return reduce(lambda a, b: a + b, [text.contains(w.lower()).cast("int") for w in words])


def query_intent(c: Column) -> Column:
    """struct(label, confidence): the intent with most keywords, the first of equals; overview at 0.1 where there is none."""
    scored = [F.struct(keyword_hits(c, words).alias("hits"), F.lit(-i).alias("place"), F.lit(label).alias("label"), F.lit(len(words)).alias("of")) for i, (label, words) in enumerate(INTENTS.items())]
    best = F.array_max(F.array(*scored))
    sure = F.round(F.least(F.lit(1.0), best["hits"] / best["of"] + 0.3), 2)
    return F.when(best["hits"] > 0, F.struct(best["label"].alias("label"), sure.alias("confidence"))).otherwise(
        F.struct(F.lit("overview").alias("label"), F.lit(0.1).alias("confidence"))
    )


# Words added to a query by its intent, for business and for technical wording.
BUSINESS_WORDS = {
    "mapping": "データ変換 対応関係 入出力マッピング", "flowchart": "処理フロー 業務手順 シーケンス図", "api": "API連携 インターフェース仕様 呼出先",
    "field": "データ項目 フィールド定義 カラム仕様", "rule": "ビジネスルール 判定条件 分岐ロジック", "overview": "システム概要 全体構成 アーキテクチャ",
}
TECHNICAL_WORDS = {
    "mapping": "transform mapping table column conversion", "flowchart": "sequence flow diagram process step", "api": "endpoint request response interface call",
    "field": "field column schema data type", "rule": "condition branch logic validation check", "overview": "architecture module system component",
}


def expanded(query: Column, intent: Column, words: dict[str, str]) -> Column:
    return F.concat_ws(" ", query, first_match([(intent == k, F.lit(v)) for k, v in words.items()], F.lit("")))


# Words of a question that ask for a kind of chunk.
CHUNK_TYPE_WORDS = {
    "api_spec": ("api", "endpoint", "http", "get ", "post ", "put ", "delete "),
    "mapping_table": ("mapping", "マッピング", "変換", "transform"),
    "business_rule": ("condition", "条件", "rule", "ルール", "business rule"),
    "flowchart": ("flow", "フロー", "sequence", "シーケンス"),
    "overview": ("overview", "概要", "summary", "サマリ"),
}


def chunk_type_hints(query: Column) -> Column:
    """All kinds of chunks that a question asks for, in the order of the list."""
    low = F.lower(query)
    return F.array_compact(F.array(*[F.when(reduce(lambda a, b: a | b, [low.contains(w) for w in words]), F.lit(kind)) for kind, words in CHUNK_TYPE_WORDS.items()]))


# Sheets from which on hints are too broad, in number and as a share of all.
MOST_HINT_SHEETS, MOST_HINT_SHARE = 10, 0.5


def hint_quality(sheets: Column, total: Column) -> Column:
    """none without sheets, weak for too many of them, else strong. ``sheets``, ``total``: numbers of sheets."""
    return F.when(F.coalesce(sheets, F.lit(0)) <= 0, "none").when((sheets > MOST_HINT_SHEETS) | (sheets > total * MOST_HINT_SHARE), "weak").otherwise("strong")


# How sure an edge's status makes it.
STATUS_CONFIDENCE = {"CONFIRMED": 1.0, "CANDIDATE": 0.6, "POSSIBLY_RELATED": 0.3, "NEEDS_REVIEW": 0.1}


def status_confidence(status: Column) -> Column:
    return first_match([(F.upper(status) == s, F.lit(v)) for s, v in STATUS_CONFIDENCE.items()], F.lit(0.5))
