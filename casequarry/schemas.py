"""Declared schemas of the engine's tables and records."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, MapType, StringType, StructType

_SPAN = "struct<start:int,end:int,text:string>"
_EVENTS = "array<struct<date:string,text:string>>"


def _schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _lazy(ddl: str):
    return lambda: _schema(ddl)


_TABLES = {
    "search_hit": "id bigint, filepath_local string, download_url string, file_url string, pdf_url string, url string, absolute_url string,"
    " short_description string, description string, document_type string, court string, court_id string",
    "pipeline_row": "search_result_id bigint, build_id string, short_description string, document_type string, doc_type_id string, pdf_url string,"
    " pdf_url_strategy string, facts_start bigint, facts_end bigint, facts_text string, facts_text_masked string, extractor_method string,"
    " extractor_notes array<string>, extractor_confidence string, targets_case_ids string, resolved_citation_count bigint, cite_hits int,"
    " arg_marker_hits int, cite_hits_per_10k_chars double, arg_hits_per_10k_chars double, total_citations int, case_citations int,"
    " unique_case_citations int, short_form_count int, statute_count int, secondary_count int, normalized_case_cites array<string>",
    "failure": "search_id bigint, reason string, detail string, pdf_url string, notes array<string>",
    "citation_cache": "normalized string, resolved_id string, resolution_status string, confidence double, timestamp string, resolver_version string",
    "extraction": f"schema_version string, extractor_version string, confidence string, facts_span {_SPAN}, parties array<string>,"
    f" procedural_posture string, key_events {_EVENTS}, record_citations array<string>, case_citations array<string>, notes array<string>,"
    " doc_type_id string, provenance map<string,string>",
    "wire_1": f"has_facts boolean, facts_start_anchor string, facts_end_anchor string, parties array<string>, procedural_posture string,"
    f" key_events {_EVENTS}, record_citations array<string>, case_citations array<string>, confidence string, notes array<string>",
    "wire_2": f"has_facts boolean, facts_start_anchor string, facts_end_anchor string, parties array<string>, procedural_posture string,"
    f" key_events {_EVENTS}, record_citations array<struct<as_printed:string,prefix:string,pages:array<string>>>, case_citations array<string>,"
    " confidence string, notes array<string>",
    "gold": "gold_id string, search_result_id bigint, source string, pdf_path string, pdf_url string, doc_type_id string, stratum map<string,string>,"
    " rules_span array<int>, rules_confidence string, rules_notes string, rules_method string, doc_sha1 string, doc_chars int,"
    " label struct<rating:string,has_facts:boolean,gold_span:array<int>,notes:string,labeled_at:string,labeler:string>, status string,"
    " suggestion struct<judge_model:string,judge_version:string,judge_run:string,document_kind:string,has_facts:boolean,confidence:string,"
    "summary:string,rules_rating:string,suggested_span:array<int>,span_basis:string>",
    "verdict": "gold_id string, search_result_id bigint, source string, method_a string, method_b string, span_a array<int>, span_b array<int>,"
    " document_kind string, is_brief_with_facts boolean, rating_a string, issues_a array<string>, comment_a string, rating_b string,"
    " issues_b array<string>, comment_b string, preferred string, corrected_span array<int>, corrected_notes array<string>, confidence string,"
    " summary string, judge_model string, judge_version string, prompt_sha string, cost_usd double, latency_s double, cached boolean, error string",
    "judge_wire": "document_kind string, is_brief_with_facts boolean, candidate_a struct<rating:string,issues:array<string>,comment:string>,"
    " candidate_b struct<rating:string,issues:array<string>,comment:string>, preferred string, corrected_start_anchor string,"
    " corrected_end_anchor string, confidence string, summary string",
    "doc_eval": "gold_id string, search_result_id bigint, source string, stratum map<string,string>, method string, extractor_version string,"
    " backend string, model_id string, prompt_sha string, gold_status string, is_gold boolean, human_rating string, gold_has_facts boolean,"
    " reference_span array<int>, pred_span array<int>, iou double, auto_rating string, span_found boolean, pred_confidence string,"
    " validation_ok boolean, flags array<string>, citation_fidelity double, citation_support double, n_citations int, n_nonverbatim_citations int,"
    " n_parties int, n_key_events int, n_record_cites int, n_case_cites int, has_posture boolean, extractor_notes array<string>, cost_usd double,"
    " latency_s double, input_tokens bigint, output_tokens bigint, cached boolean, error string",
    "request_log": "ts string, method string, source_kind string, client string, doc_chars bigint, compare boolean, latency_s double, cost_usd double,"
    " escalated boolean, span_found boolean, validation_ok boolean, flags array<string>, error string",
    "response": "key string, model string, requested_model string, stop_reason string, text string,"
    " usage struct<input_tokens:bigint,output_tokens:bigint,cache_creation_input_tokens:bigint,cache_read_input_tokens:bigint>,"
    " cli_cost_usd double, gold_id string",
    "resolver_result": "normalized string, results array<struct<cluster_id:bigint,citation:array<string>>>",
    "ranking": "model string, query_id string, rank int, case_id string, score double",
}
TABLES = {name: _lazy(ddl) for name, ddl in _TABLES.items()}


def schema(name: str) -> StructType:
    return TABLES[name]()


def ddl(name: str) -> str:
    return _TABLES[name]


def json_schema(name: str) -> dict:
    """A table's schema as nested plain values."""
    return schema(name).jsonValue()


_PLAIN = {StringType: "string", BooleanType: "boolean", IntegerType: "integer", LongType: "integer", DoubleType: "number", FloatType: "number"}
#: What a reply may leave empty, and the words that it must choose from.
_NULLABLE = {"facts_start_anchor", "facts_end_anchor", "procedural_posture", "date", "prefix", "corrected_start_anchor", "corrected_end_anchor"}
_CHOICES = {"confidence": ["high", "medium", "low"]}


def _wire(kind: DataType, name: str = "") -> dict:
    if isinstance(kind, StructType):
        fields = {f.name: _wire(f.dataType, f.name) for f in kind.fields}
        return {"type": "object", "properties": fields, "required": list(fields), "additionalProperties": False}
    if isinstance(kind, ArrayType):
        return {"type": "array", "items": _wire(kind.elementType)}
    if isinstance(kind, MapType):
        return {"type": "object", "additionalProperties": _wire(kind.valueType)}
    plain = _PLAIN[type(kind)]
    if name in _CHOICES:
        return {"type": plain, "enum": _CHOICES[name]}
    return {"anyOf": [{"type": plain}, {"type": "null"}]} if name in _NULLABLE else {"type": plain}


def wire_schema(name: str) -> dict:
    """JSON schema of a declared record for a model's structured output.

    Nested records stand in their place, so there are no references; every object lists all its
    fields as required and allows no others.
    """
    if name not in TABLES:
        raise KeyError(f"unknown record {name!r}; known: {sorted(TABLES)}")
    return _wire(schema(name))
