from .inferred import flatten_json, infer_schema, json_paths, typed_json, variant_schema
from .landed import (
    last_answers,
    parse_json,
    parse_responses,
    read_pages,
    read_record,
    read_schema,
    union_pages,
    until_first_refusal,
)
from .pages import check_pages, fitting, load_pages, page_files, rejects, until_empty

__all__ = [
    "check_pages",
    "fitting",
    "flatten_json",
    "infer_schema",
    "json_paths",
    "last_answers",
    "load_pages",
    "page_files",
    "parse_json",
    "parse_responses",
    "read_pages",
    "read_record",
    "read_schema",
    "rejects",
    "typed_json",
    "union_pages",
    "until_empty",
    "until_first_refusal",
    "variant_schema",
]
