"""Deterministic identifiers and content hashes, as JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import normalize_id

# The prefix of a canonical id by entity type.
TYPE_PREFIX = {
    "System": "system", "Middleware": "middleware", "Interface": "interface", "BusinessProcess": "process", "FunctionModule": "function",
    "FlowNode": "flow_node", "DecisionPoint": "decision", "BranchCondition": "branch_cond", "APIOperation": "apiop", "APICallStep": "apistep",
    "APICallSequence": "apiseq", "MappingDefinition": "mappingdef", "FieldMapping": "mapping", "Field": "field", "DataEntity": "data",
    "FileObject": "file", "TransformationRule": "rule_transform", "ConversionRule": "rule_convert", "BusinessRule": "rule_business",
    "FilterCondition": "filter", "StatusValue": "status", "ScriptStep": "script_step", "FileOperation": "fileop", "ResultReturn": "result_return",
    "ErrorHandlingStep": "error_step", "Annotation": "annotation", "ImplementationSpec": "impl_spec", "DataRetrievalCondition": "retrieval_cond",
    "FieldDefinition": "fielddef", "Parameter": "param", "EnumValue": "enum", "BusinessStep": "bstep", "BusinessObject": "bobj", "Script": "script",
    "Requirement": "req", "RecordType": "rectype", "Issue": "issue", "Constraint": "constraint", "APIEndpoint": "endpoint", "Condition": "condition",
    "DefaultValueRule": "rule_default", "InternalSystem": "internal_sys", "IntegrationTool": "tool", "ExternalSystem": "ext_system",
    "ReviewTask": "review_task", "Loop": "loop", "StartEndNode": "startend", "ResponsePayload": "resp_payload", "RequestPayload": "req_payload",
    "QueryCondition": "query_cond", "CalculationRule": "rule_calc", "LookupRule": "rule_lookup", "FixedValueRule": "rule_fixed", "Batch": "batch", "Job": "job",
}
# How far an entity type's names reach.
GLOBAL_TYPES = ("System", "Middleware", "Interface")
SHEET_TYPES = ("Field", "FieldMapping", "FilterCondition", "FieldDefinition", "EnumValue", "Parameter")
STEP_TYPES = ("FlowNode", "ScriptStep", "APICallStep", "FileOperation", "BusinessStep", "ErrorHandlingStep", "ResultReturn")


def short_hash(c: Column, length: int) -> Column:
    """The first hex digits of the SHA-256 of a text or of bytes."""
    return F.substring(F.sha2(c, 256), 1, length)


def document_id(project: Column, path: Column, separator: str = "::") -> Column:
    return short_hash(F.concat_ws(separator, project, path), 16)


def file_hash(content: Column, head: int = 65_536) -> Column:
    """Hash of a file's first bytes."""
    return short_hash(F.substring(content, 1, head), 16)


def content_hash(text: Column) -> Column:
    return short_hash(text, 12)


def unit_label(sheet_name: Column) -> Column:
    """s07 for sheet_07, else the first 20 characters of the sheet's name, else doc."""
    number = F.regexp_extract(sheet_name, r"^sheet_(\d+)", 1)
    return (
        F.when(F.coalesce(sheet_name, F.lit("")) == "", F.lit("doc"))
        .when(number != "", F.concat(F.lit("s"), number))
        .otherwise(F.substring(sheet_name, 1, 20))
    )


def chunk_id(source_type: Column, document: Column, label: Column, index: Column, digest: Column) -> Column:
    return F.format_string("%s_%s_%s_c%03d_%s", source_type, document, label, index.cast("int"), digest)


def type_prefix(entity_type: Column) -> Column:
    """The listed prefix, for other types their first 20 characters in small letters."""
    table = F.create_map(*[F.lit(x) for pair in TYPE_PREFIX.items() for x in pair])
    return F.coalesce(F.try_element_at(table, entity_type), F.substring(F.lower(entity_type), 1, 20))


def canonical_id(
    entity_type: Column, name: Column, project: Column, workbook: Column, sheet: Column, parent: Column | None = None, mode: str = "ascii"
) -> Column:
    """An entity's id: prefix, scope and normalised name. Names of global types are shared by all workbooks,
    those of sheet types by a sheet, those of steps by their parent function (or sheet), all others by a workbook."""
    key = F.substring(normalize_id(name, mode), 1, 50)
    book, page = normalize_id(workbook, mode), normalize_id(sheet, mode)
    above = page if parent is None else F.when(F.coalesce(parent, F.lit("")) != "", F.substring(normalize_id(parent, mode), 1, 30)).otherwise(page)
    prefix = type_prefix(entity_type)
    return (
        F.when(entity_type.isin(*STEP_TYPES), F.concat_ws(":", prefix, project, book, above, key))
        .when(entity_type.isin(*SHEET_TYPES), F.concat_ws(":", prefix, project, book, page, key))
        .when(entity_type.isin(*GLOBAL_TYPES), F.concat_ws(":", prefix, project, key))
        .otherwise(F.concat_ws(":", prefix, project, book, key))
    )
